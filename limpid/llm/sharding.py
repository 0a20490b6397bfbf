"""Weighted shards by rendezvous hashing of a stable record key.

For each record every shard draws a number from the record's key and its own number alone; the record goes to the shard
whose draw, divided by its weight, is best. No shard's draw depends on the others, so a shard that is added only takes
records to itself, one that is removed only gives up its own, and a changed weight moves records to or from that shard
alone. Nothing is looked up or kept: the place of a record is an expression over its key.

Hard rows: a missing key counts as an empty one; rows without key, and rows that share a key, share a shard, however
many they are (a shard is a label and not a task, so that burdens no task). A missing text has no bytes. An empty table
gives an empty one. Other columns stay as they are and may have any name but those that are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.functions.names import named
from limpid.llm.storage import stored

# About so many records of a shard are numbered in one task.
CELL = 1 << 18


def _cost(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight of the shard's draw u in (0, 1): an exponential waiting time, so the least of them falls to a shard
    in proportion to its weight."""
    draw = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("double")
    return -F.log((draw + 0.5) / F.lit(float(1 << 52))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """struct(cost, shard) of the best of the shards first, first + 1, ...; equal costs go to the smaller number."""
    if not weights or not all(0 < w < float("inf") for w in weights):
        raise ValueError("weights must be positive and finite, one at least")
    text = F.coalesce(key.cast("string"), F.lit(""))
    found = [F.struct(_cost(text, first + i, w).alias("cost"), F.lit(first + i).alias("shard")) for i, w in enumerate(weights)]
    return F.array_min(F.array(*found))


def assign(docs: DataFrame, weights: Sequence[float], added: Sequence[float] = (), key: str = "doc_id") -> DataFrame:
    """docs with `shard`, and `grown_shard`: the shard once shards of the weights `added` have joined. No shuffle."""
    best = rendezvous(named(key), weights)
    marked = docs.withColumn("_best", best)
    grown = F.col("_best")
    if added:
        grown = F.array_min(F.array(grown, rendezvous(named(key), added, len(weights))))
    return marked.withColumns({"shard": F.col("_best.shard"), "grown_shard": grown.getField("shard")}).drop("_best")


def moved(docs: DataFrame, weights: Sequence[float], added: Sequence[float], key: str = "doc_id") -> DataFrame:
    """The rows that change their shard when shards join, with both numbers: what a resharding has to copy."""
    return assign(docs, weights, added, key).filter("shard != grown_shard")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id") -> None:
    """Whole rows as Parquet below path/shard=<n>. Spark deals rows by shard and splits a shard that is large or holds a hot
    key over several tasks, each with a file of its own, so no task holds a shard."""
    assign(docs, weights, key=key).drop("grown_shard").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def manifest(docs: DataFrame, weights: Sequence[float], added: Sequence[float] = (), cell: int = CELL) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard of each row: the index of the shards.

    size is the text's UTF-8 bytes plus 1, slot the place of a record in its shard, from 0 without gaps. Records stand in
    the order of a digest of doc_id, size and checksum, so slots depend on the records alone, not on files or tasks.

    Records equal in those three are counted instead of moved. A count over `cell` is cut into pieces, each with a digest
    of its own, so no piece is long and the pieces of a group of copies are dealt out. Slots are running sums inside cells,
    ranges of the digest with about `cell` pieces of a shard, shifted by the records in the cells before.
    """
    text, same = F.col("text"), ["doc_id", "size", "text_crc32"]
    plain = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    counted = plain.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(cell).cast("long")))
    cut = assign(counted, weights, added).select(*same, "shard", "grown_shard", "copies", start.alias("at"))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32", F.floor(F.col("at") / cell))
    pieces = stored(cut.withColumn("copies", F.least(F.col("copies") - F.col("at"), F.lit(cell))).withColumn("digest", F.md5(name)), "pieces")

    most = pieces.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    bits = (most // cell).bit_length()
    number = F.conv(F.substring("digest", 1, 12), 16, 10).cast("long")
    placed = pieces.withColumn("cell", F.shiftright(number, 48 - bits))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        placed.groupBy("shard", "cell")
        .agg(F.sum("copies").alias("own"))
        .select("shard", "cell", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("offset"))
    )
    order = [F.asc_nulls_first(c) for c in ("digest", *same, "at")]
    inside = Window.partitionBy("shard", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.col("earlier"), F.lit(0))
    slots = F.explode(F.sequence(first, first + F.col("copies") - 1))
    return (
        placed.withColumn("earlier", F.sum("copies").over(inside))
        .join(cells, ["shard", "cell"])
        .select(*same, "shard", slots.alias("slot"), "grown_shard")
    )
