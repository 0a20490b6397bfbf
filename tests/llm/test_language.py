import numpy as np
from pyspark.sql import functions as F

from limpid.llm.language import UND, HashArray, identify, strings, train
from limpid.llm.queries import op1_language

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_no_clean_text_rejected(spark):
    got = op1_language(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id")
    row = got.filter("held_out").agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("rejected").cast("int"))).first()
    assert row[0] > 200 and row[1] > 0.98 and row[2] == 0


def test_probabilities_add_up_to_one(spark):
    docs = spark.createDataFrame([(i, "abc cab bca cc aab" * 3, "x") for i in range(20)], "doc_id long, text string, lang string")
    model = train(docs)
    alphabet = np.array([ord(c) for c in "abc "], np.uint64)
    for context in ("abc", "  a", "zzz", "cab"):
        high = sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(context))
        p = np.exp2(model.scores(np.uint64(high) + alphabet)[:, 0]).sum()
        assert 0.7 < p <= 1.001


def test_edges(spark, documents):
    learn = spark.createDataFrame(
        [(i, t, lang) for i in range(30) for t, lang in ((f"the cat and the dog {i}", "en"), (f"der hund und die katze {i}", "de"), (None, "en"), ("x", None))],
        "doc_id long, text string, lang string",
    )
    model = train(learn)
    texts = [None, "", "123 !?", "the dog", "THE DOG", "die katze " * 40_000, "漢字", "the dog", "\0\n"]
    got = {r.doc_id: r for r in identify(documents(texts), model).collect()}
    assert [got[i].lang_pred for i in range(9)] == [UND, UND, UND, "en", "en", "de", got[6].lang_pred, "en", UND]
    assert got[6].lang_pred != UND and got[3].score == got[7].score and all(0 <= r.score <= 1 for r in got.values())
    assert got[0].rejected and got[0].score == 0 and not got[5].rejected
    assert identify(documents([]), model).collect() == []
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert train(empty) is None
    assert identify(documents(["a"]), None).first().lang_pred == UND


def test_hash_array_and_strings():
    keys = np.arange(1, 5000, 7, dtype=np.uint64)
    table = HashArray(keys)
    found = table.find(np.arange(5000, dtype=np.uint64))
    assert (table.order[found[keys.astype(int)]] == np.arange(keys.size)).all() and (found >= 0).sum() == keys.size
    packed, text, has = strings(["Ab", "", "1", "é!!b"])
    assert text.tolist() == [0, 0, 3, 3, 3] and has.tolist() == [True, False, False, True]
    assert (packed & np.uint64(0xFFFF)).tolist() == [97, 98, 233, 32, 98]


def test_many_strings_keep_discounts_and_languages(spark, documents):
    import random

    rng = random.Random(3)
    han = lambda: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    rows = [(i, "der hund und die katze und das haus " * 40 + f"b{chr(97 + i % 26)}", "de") for i in range(40)]
    rows += [(100 + i, han(), "zh") for i in range(200)] + [(500 + i, "ⴰⴱⴲⴳⴴⴵⴶ", "zgh") for i in range(1)] * 1
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, cut = train(learn), train(learn, max_strings=600)
    assert cut.names == whole.names and sum(g.order.size for g in cut.grams[1:]) < 4000 < sum(g.order.size for g in whole.grams[1:])
    assert np.allclose(cut.unseen, whole.unseen)  # floor, continuation counts and discounts of single characters
    names = [r.lang_pred for r in sorted(identify(documents(["der hund", rows[60][1], "ⴰⴱⴲ"]), cut).collect(), key=lambda r: r.doc_id)]
    assert names == ["de", "zh", "zgh" if "zgh" in whole.names else names[2]]
    every = np.unique(strings([t for _, t, _ in rows])[0] & np.uint64(0xFFFF))
    for context in ("hun", "und", rows[60][1][:3]):
        high = sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(context))
        p, full = (np.exp2(m.scores(np.uint64(high) + every)).sum(axis=0) for m in (cut, whole))
        assert (abs(p - full) < 0.1).all() and (p <= 1.001).all()
    context = sum(ord(c) << (16 * (3 - i)) for i, c in enumerate("der"))
    one = np.array([context + 32], np.uint64)
    assert np.allclose(cut.scores(one)[:, 0], whole.scores(one)[:, 0], atol=0.01)


def _plain_model(texts, alphabet):
    """Interpolated Kneser-Ney of one language with dictionaries: a function from (context, character) to a probability."""
    from collections import Counter

    counts = Counter()
    for t in texts:
        s = _symbols(t)
        counts.update(("   " + s)[i : i + 4] for i in range(len(s)))
    levels = [counts]
    for n in (3, 2, 1):
        levels.append(Counter(k[-n:] for k in levels[-1]))

    def p(context, c):
        out = 1 / (4 * max(2, alphabet))
        for n, level in zip((1, 2, 3, 4), reversed(levels), strict=True):
            before = context[len(context) - n + 1 :] if n > 1 else ""
            total = sum(v for k, v in level.items() if k[:-1] == before)
            if total:
                one, two = (sum(v == x for v in level.values()) for x in (1, 2))
                d = min(0.95, max(0.1, one / (one + 2 * two))) if one + two else 0.5
                kinds = sum(k[:-1] == before for k in level)
                out = max(level[before + c] - d, 0) / total + d * kinds / total * out
        return out

    return p


def _symbols(text):
    """Small letters, one blank for each run of others after a letter."""
    out = ""
    for c in text.lower():
        if c.isalpha():
            out += c
        elif out and out[-1] != " ":
            out += " "
    return out


def test_cross_entropy_as_a_plain_kneser_ney(spark):
    import math

    from limpid.llm.language import learn

    texts = {"en": ["the cat and the dog", "a cat, a hat!", "Then there"], "de": ["der hund und die katze", "das haus; ein hund"]}
    rows = [(lang, t) for lang, ts in texts.items() for t in ts]
    model = learn(spark.createDataFrame(rows, "lang string, text string"), 10**6)
    assert model.names == ["de", "en"]
    asked = ["the hat", "die hunde", "x", "Katze -- cat", "the"]
    bits, count, _ = model.entropy(asked)
    # What no language has seen has one probability for all of them.
    alphabet = len({c for ts in texts.values() for t in ts for c in _symbols(t)})
    plain = {lang: _plain_model(ts, alphabet) for lang, ts in texts.items()}
    for i, t in enumerate(asked):
        s = "   " + _symbols(t)
        assert count[i] == len(s) - 3
        for k, lang in enumerate(model.names):
            p = plain[lang]
            expected = -sum(math.log2(p(s[j - 3 : j], s[j])) for j in range(3, len(s))) / (len(s) - 3)
            assert abs(bits[i, k] - expected) < 1e-4, (t, lang, bits[i, k], expected)


def test_cuts_of_a_long_text_change_nothing(monkeypatch):
    from limpid.llm import language

    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(list("abé 1漢.\n"), 700)) for _ in range(5)] + [" " * 300 + "ab" + "1" * 400 + "c" * 90, "", "7" * 500, "a" * 333]
    whole = strings(texts)
    for piece in (1, 2, 5, 64, 100):
        monkeypatch.setattr(language, "_PIECE", piece)
        packed, text, has = [], [], np.zeros(len(texts), bool)
        for part, number, skip in language._pieces(texts):
            p, t, h = strings(part, skip)
            packed.append(p)
            text.append(number[t])
            np.logical_or.at(has, number, h)
        assert (np.concatenate(packed) == whole[0]).all() and (np.concatenate(text) == whole[1]).all() and (has == whole[2]).all()
