"""Rendezvous shards against a plain version in Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from limpid.llm.sharding import assign, manifest, moved, write_shards


def plain_shard(key, weights):
    text = "" if key is None else str(key)

    def cost(i, w):
        u = (int(hashlib.md5(f"{text}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / w, i

    return min(cost(i, w) for i, w in enumerate(weights))[1]


def plain_manifest(rows, weights, added, cell):
    """rows: (doc_id, text). Slots by the digest of each record, copies in pieces of `cell`."""
    records = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    shards = defaultdict(list)
    for (d, size, crc), n in records.items():
        for i, at in enumerate(range(0, n, cell)):
            digest = hashlib.md5(f"{'' if d is None else d}:{size}:{crc}:{i}".encode()).hexdigest()
            shards[plain_shard(d, weights)].append((digest, (d, size, crc), min(cell, n - at)))
    out = []
    for shard, pieces in shards.items():
        slot = 0
        for _, (d, size, crc), n in sorted(pieces, key=lambda p: p[0]):
            for _ in range(n):
                out.append((d, size, crc, shard, slot, plain_shard(d, [*weights, *added])))
                slot += 1
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("cell", [3, 1 << 18])
@pytest.mark.parametrize("weights, added", [([1.0] * 16, [1.0]), ([1.0, 4.0, 2.5], [3.0, 0.5]), ([1.0], [])])
def test_manifest_equals_the_plain_version(spark, cell, weights, added):
    texts = ["", None, "a", "é𝄞", "long " * 5000]
    rows = [(i, texts[i % 5]) for i in range(300)]
    rows += [(None, texts[i % 5]) for i in range(100)]  # a quarter without key
    rows += [(7, "copy")] * 120 + [(-5, None)] * 3 + [(2**62, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as slot", "'x' as digest", "3 as cell")
    assert rows_of(manifest(docs, weights, added, cell=cell)) == plain_manifest(rows, weights, added, cell)


def test_shards_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = rows_of(manifest(docs, [1.0] * 16, [1.0]))
    assert found == plain_manifest([(r.doc_id, r.text) for r in docs.collect()], [1.0] * 16, [1.0], 1 << 18)
    assert all(grown in (shard, 16) for *_, shard, _, grown in found)


def test_rows_fall_to_shards_by_weight(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = {r["shard"]: r["count"] for r in assign(keys, [1.0, 2.0, 5.0]).groupBy("shard").count().collect()}
    for shard, weight in enumerate((1, 2, 5)):
        assert abs(n[shard] / 20_000 - weight / 8) < 0.015


def test_few_rows_move_and_only_to_the_new_shard(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    gone = [r["grown_shard"] for r in moved(keys, [1.0] * 7, [1.0]).collect()]
    assert set(gone) == {7}
    assert abs(len(gone) / 20_000 - 1 / 8) < 0.01


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = manifest(docs, [1.0] * 16, [1.0])
    assert found.collect() == []
    assert found.columns == ["doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"]


def test_written_shards_hold_every_row_whole(spark, documents, tmp_path):
    docs = documents([f"text {i}" * (i % 7) for i in range(200)]).unionByName(documents(["copy"] * 50))
    write_shards(docs, str(tmp_path / "shards"), [1.0, 2.0, 1.0])
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows_of(back.select(*docs.columns)) == rows_of(docs)
    assert all(r.shard == plain_shard(r.doc_id, [1.0, 2.0, 1.0]) for r in back.collect())


@pytest.mark.parametrize("weights", [[], [0.0], [1.0, -1.0], [float("inf")], [float("nan")]])
def test_odd_weights_are_refused(spark, weights):
    with pytest.raises(ValueError):
        assign(spark.range(1).withColumnRenamed("id", "doc_id"), weights)
