"""Divergence of sources against a plain version in Python."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from limpid.llm.divergence import SCALE, divergence, shared_paths, term_rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=3, ranks=200):
    """rows: (lang, source, text)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(SMALL))
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        everything = Counter()
        for s in sources:
            everything.update(counts[lang, s])

        def shares(c, kept=kept):
            whole = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + SCALE * (c[t] + 1) // whole for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(everything)

        def f(p, q):
            return (p - q) ** 2 // q

        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:ranks])]
    return sorted(out)


def found(df, **more):
    return sorted(tuple(r) for r in divergence(df, **more).collect())


ROWS = [
    ("en", "a", "The cat, the DOG and the é𝄞x 7cats"),
    ("en", "a", "the cat the cat"),
    ("en", "b", "the dog the dog the end"),
    ("en", "b", None),
    ("en", "c", "the the the cat dog and and"),
    ("en", "none", "123 _ - "),  # a group without a term
    ("en", None, "the cat und Übel"),
    ("en", None, "and end é𝄞x end Übel"),
    ("en", "ä", "cat cat end Übel"),
    ("fr", "a", "un deux"),  # nothing is kept
    ("fr", "b", ""),
    (None, "a", "alone alone"),
    ("", "b", "alone and alone"),
    (None, None, "alone"),
    ("x", "only", "one one one"),  # a language with one source
] + [("en", "hot", "the cat sat on the mat")] * 20


@pytest.fixture
def docs(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "lang string, source string, text string")
        return df.selectExpr("lang", "source", "text", "1L as doc_id", "'x' as term", "2 as n", "3 as value", "4 as row", "5 as v")

    return make


@pytest.mark.parametrize("least", [1, 3])
@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_divergence_equals_the_plain_version(spark, docs, least, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert found(docs(ROWS), least=least) == plain(ROWS, least)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_given_documents_and_few_ranks(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(df, ranks=7) == plain([(r.lang, r.source, r.text) for r in df.collect()], ranks=7)


def test_every_two_counts_of_a_term_meet_once(spark, docs):
    rows = term_rows(docs(ROWS), 1)
    expected = Counter()
    for r in rows.collect():
        items = [tuple(i) for i in r.row]
        assert items == sorted(items, key=lambda i: i[0].encode())
        expected.update((r.lang, *a, *b) for k, a in enumerate(items) for b in items[k + 1 :])
    assert {tuple(r)[:5]: r.terms for r in shared_paths(rows).collect()} == dict(expected)


def test_shared_paths_need_fewer_corrections_than_terms(spark):
    """Terms with one and the same row, and rows with one beginning, are one path of the tree."""
    text = " ".join("abcdefghij"[i % 10] * (1 + i // 10) for i in range(300))
    df = spark.createDataFrame([("en", f"s{i}", text) for i in range(5)] * 2, "lang string, source string, text string")
    rows = term_rows(df)
    assert rows.count() == 300
    assert sorted(r.terms for r in shared_paths(rows).collect()) == [300] * 10


def test_one_very_long_text_and_many_terms(spark, docs):
    words = ["abcdefghij"[i % 10] * (1 + i // 10 % 40) for i in range(400_000)]
    rows = [("en", "a", " ".join(words)), ("en", "b", "a b cc cc"), ("en", "a", "a b"), ("en", "c", "x" * 3_000_000), ("en", "b", "a cc b")]
    assert found(docs(rows)) == plain(rows)


def test_empty_table_and_texts(spark, docs):
    assert found(docs([])) == []
    rows = [("en", "a", ""), ("en", "b", None), (None, None, None)]
    assert found(docs(rows)) == plain(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_counts_beyond_long_products(spark):
    from limpid.llm.divergence import _share

    df = spark.createDataFrame([(5 * 10**12, 9 * 10**12, 10**6)], "n long, size long, v long")
    assert df.select(_share("n", "size")).first()[0] == 1 + SCALE * (5 * 10**12 + 1) // (9 * 10**12 + 10**6)
    assert df.select(_share(F.lit(0), "size")).first()[0] == 1 + SCALE // (9 * 10**12 + 10**6)
