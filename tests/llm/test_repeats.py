import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from limpid.llm.repeats import _pieces, remove_repeats, runs

DATA = "/root/testdata/sf0.001/documents.parquet"


def brute(texts, window):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if seen[raw[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def rows(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.doc_id)]


def test_as_brute_force_on_documents(spark):
    texts = pq.read_table(DATA)["text"].to_pylist()
    assert rows(remove_repeats(spark.read.parquet(DATA))) == brute(texts, 200)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_short_windows_with_ties_and_periods(spark, documents, hot):
    rng = random.Random(2)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randint(3, 30))) for _ in range(12)]
    texts = [None, "", "ab", "a" * 300, "ab" * 90, "xyz" * 40_000]
    for _ in range(150):
        texts.append("".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) + rng.choice("xyzäöü"))
    texts += texts[20:24]
    assert rows(remove_repeats(documents(texts), window=20, gram=6, hot=hot)) == brute(texts, 20)


def test_empty_table_missing_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert remove_repeats(spark.createDataFrame([], schema)).collect() == []
    long = " ".join(str(i) for i in range(200))
    got = remove_repeats(spark.createDataFrame([(None, long), (4, long), (4, long), (4, "z" * 150), (None, None)], schema), keep_text=True)
    assert sorted((str(r.doc_id), r.n_removed, r.kept_text) for r in got.collect()) == sorted(
        [("None", len(long), ""), ("4", len(long), ""), ("4", len(long), ""), ("4", 0, "z" * 150), ("None", 0, "")]
    )


def test_texts_of_one_short_hash_without_ids(spark):
    # Two clean texts with the same F.hash; the second shares a passage with a third one.
    passage = " ".join(str(i) for i in range(100))
    first, second = (f"{passage_or_own} {n}" for passage_or_own, n in _same_short_hash(spark, passage))
    third = "third " + passage
    got = remove_repeats(spark.createDataFrame([(None, t) for t in (first, second, third)], "doc_id long, text string"), keep_text=True)
    want = brute([first, second, third], 200)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == sorted(want)


def _same_short_hash(spark, passage):
    """(text, number) of a text without the passage and one with it whose 32-bit hashes are equal."""
    from pyspark.sql import functions as F

    n = spark.range(400_000)
    own = " ".join(str(i) for i in range(500, 600))
    a, b = (n.select(F.col("id").alias(c), F.hash(F.concat(F.lit(t + " "), F.col("id").cast("string"))).alias("h")) for c, t in (("a", own), ("b", passage)))
    pair = a.join(b, "h").orderBy("a", "b").first()
    return [(own, pair["a"]), (passage, pair["b"])]


def test_copies_of_a_row_hold_their_ranges_once(spark):
    long = " ".join(str(i) for i in range(200))
    got = remove_repeats(spark.createDataFrame([(4, long)] * 20 + [(5, "x " + long)], "doc_id long, text string"))
    assert rows(got) == brute([long] * 20 + ["x " + long], 200)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_heavy_buckets_and_runs(spark, documents, hot, monkeypatch):
    """Most runs lie in a few buckets, and many are equal; every part of a salted run is right by itself."""
    from limpid.llm import repeats

    rng = random.Random(4)
    line = "this line stands in nearly every text, " * 2
    texts = [line * (i % 4) + "".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 60))) + line[: i % 50] for i in range(120)]
    texts += [line] * 60 + [None, "", "z" * 400]
    seen = []
    monkeypatch.setattr(repeats, "heavy_numbers", lambda df, c: seen.append(1) or [r[0] for r in df.groupBy(c).count().filter("count > 20").select(c).collect()])
    assert rows(remove_repeats(documents(texts), window=30, gram=8, hot=hot)) == brute(texts, 30)
    assert seen


@pytest.mark.parametrize("batch", [1, 2, 7, 1000])
@pytest.mark.parametrize("hot", [2, 3, 100])
def test_runs_are_judged_in_any_batches(batch, hot):
    import numpy as np
    import pyarrow as pa

    from limpid.llm.repeats import HOT_ALONE, HOT_OPEN, OPEN, OPEN_ALONE, SETTLED, _Judge

    rng = random.Random(batch * 10 + hot)
    pairs = sorted((rng.randrange(12), rng.randrange(9)) for _ in range(60)) + [(50, 1)] * 5 + [(60, i) for i in range(6)] + [(70, 1), (70, 1), (80, 2)]
    heavy = [3, 60]
    bucket, run = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
    table = pa.RecordBatch.from_pydict({"doc_id": list(range(len(pairs))), "mark": [b"m"] * len(pairs), "lo": [0] * len(pairs), "n": [1] * len(pairs), "bucket": bucket, "run": run})
    judge, out = _Judge(heavy, hot), []
    for at in range(0, len(pairs), batch):
        out += judge.feed(table.slice(at, batch))
    out += judge.feed(None)
    got = Counter((r["bucket"], int(run[r["doc_id"]]), r["kind"]) for b in out for r in b.to_pylist())
    counts, expected = Counter(pairs), Counter()
    for b in {p[0] for p in pairs}:
        own = {p: n for p, n in counts.items() if p[0] == b}
        for p, n in own.items():
            if n > 1:
                expected[(*p, SETTLED)] += n
            crowd = b in heavy or len(own) > hot
            if crowd or (len(own) > 1 and 1 in own.values()):
                kinds = (HOT_ALONE, HOT_OPEN) if crowd else (OPEN_ALONE, OPEN)
                expected[(*p, kinds[n > 1])] += 1
    # A crowded bucket between the ends of a batch is dropped at once if no run in it is alone; across batches it isn't known yet.
    useless = {b for b in {p[0] for p in pairs} if b not in heavy and 1 not in [n for p, n in counts.items() if p[0] == b]}
    clean = lambda c: {k: n for k, n in c.items() if not (k[0] in useless and k[2] == HOT_OPEN)}
    assert clean(got) == clean(expected)


def test_arrays_of_a_worker_are_small():
    """What a task holds while it looks for runs doesn't grow with its batch."""
    letters = np.random.default_rng(4).integers(97, 123, (400, 20_000), np.uint8)
    column = pa.array([bytes(x).decode() for x in letters])
    tracemalloc.start()
    for _, _, data, offsets in _pieces(column, 200):
        runs(data, offsets, 200, 50)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 48 << 20, most
