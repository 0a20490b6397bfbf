"""Work per key that stays balanced when one key holds much of the table.

A plain window sends all rows of a key to one task. Here a look at the key columns alone finds the keys that hold more than
1/HEAVY_PARTS of the rows: a sketch of frequent items over hashed keys, of fixed size, combined map-side, so neither rows nor
counts per key are shuffled for it. There are fewer than HEAVY_PARTS such keys in a table of any size, and one that is not
among them holds no more rows than a fair share of HEAVY_PARTS partitions. Where nothing is heavy, an ordinary window is
all there is. Otherwise the table is still read and shuffled once: heavy keys are dealt over many groups by a salt, and get
their value from a broadcast of one row per heavy key.

The sketch may pass a key that is not quite heavy, or find one that shares its hash with a heavy key; results don't depend
on which keys are treated as heavy.

Keys are packed in one struct: struct equality treats null fields as equal, so null keys group and join with each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.functions.names import named

HEAVY_PARTS = 4096
# Groups that a heavy key is dealt over.
SALTS = 1024
# About so many rows of a heavy key are ranked in one task.
BLOCK = 1 << 20
# Sketches are combined in so many tasks before the last one.
_MERGES = 64

_KEY, _HASH, _SALT, _ROWS, _HOT = "_key", "_hash", "_salt", "_rows", "_hot"


def _struct(keys: Sequence[str]) -> Column:
    return F.struct(*[named(k) for k in keys])


def _hashed(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[named(k) for k in keys])


def heavy_hashes(df: DataFrame, keys: Sequence[str], parts: int = HEAVY_PARTS) -> list[int]:
    """Hashes of the keys that hold more than 1/parts of the rows: fewer than ``parts`` numbers.

    Every key with more than 1.5/parts of the rows is found, whatever the order and number of the others: the sketch's error
    stays below a quarter of 1/parts.
    """
    return _frequent(df.select(_hashed(keys).alias("h")), parts)


def heavy_numbers(df: DataFrame, column: str, parts: int = HEAVY_PARTS) -> list[int]:
    """As ``heavy_hashes``, of a column of longs: its values with more than 1/parts of the rows."""
    return _frequent(df.select(named(column).alias("h")), parts)


def _frequent(numbers: DataFrame, parts: int) -> list[int]:
    tracked = 16 * parts
    sketches = numbers.groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGES)).alias("task")).agg(
        F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("rows")
    )
    # Grouped, as sketches can't be combined where there are none: an empty table gives no row.
    found = sketches.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {parts})").alias("top"), F.sum("rows").alias("rows")
    )
    return [i["item"] for row in found.collect() for i in row["top"] if i["count"] * parts > row["rows"]]


def _heavy_rows(df: DataFrame, keys: Sequence[str], hashes: list[int]) -> DataFrame:
    return df.where(_hashed(keys).isin(hashes)).withColumn(_KEY, _struct(keys))


def _spread(df: DataFrame) -> Column:
    """A salt from a row's content and its task: equal when a lost task is run again, whatever the order of its rows."""
    kinds = [named(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*kinds) + F.spark_partition_id(), F.lit(SALTS)).cast("int") + 1


def with_key_aggregates(
    df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column], parts: int = HEAVY_PARTS
) -> DataFrame:
    """Every row plus aggregates over all rows with the same key."""
    hashes = heavy_hashes(df, keys, parts)
    keyed = df.withColumn(_KEY, _struct(keys))
    own = [named(c) for c in df.columns]
    if not hashes:
        over = Window.partitionBy(_KEY)
        return keyed.select(*own, *[c.over(over).alias(n) for n, c in aggregates.items()])
    # One row for each heavy key.
    whole = F.struct(*[c.alias(n) for n, c in aggregates.items()])
    totals = _heavy_rows(df, keys, hashes).groupBy(_KEY).agg(whole.alias(_HOT))
    dealt = keyed.join(F.broadcast(totals), _KEY, "left").withColumn(_SALT, F.when(F.col(_HOT).isNull(), 0).otherwise(_spread(df)))
    over = Window.partitionBy(_KEY, _SALT)
    values = [F.when(F.col(_HOT).isNull(), c.over(over)).otherwise(F.col(_HOT)[n]).alias(n) for n, c in aggregates.items()]
    return dealt.select(*own, *values)


def with_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str = "row_number",
    parts: int = HEAVY_PARTS,
    block: int = BLOCK,
) -> DataFrame:
    """Number the rows of each key by ``order``, a unique integer column.

    Rows of heavy keys are numbered inside blocks of order values and shifted by the number of rows of the
    same key in earlier blocks. A key's range of order values is cut into one block for each ``block`` rows, so
    sparse order values make no more blocks than dense ones. Other keys are one block.
    """
    hashes = heavy_hashes(df, keys, parts)
    keyed = df.withColumn(_KEY, _struct(keys))
    own = [named(c) for c in df.columns]
    at = named(order)
    if not hashes:
        return keyed.select(*own, F.row_number().over(Window.partitionBy(_KEY).orderBy(at)).cast("long").alias(name))
    hot = _heavy_rows(df, keys, hashes)
    ranges = hot.groupBy(_KEY).agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n"))
    # Whole numbers throughout: doubles are inexact beyond 2^53. One row for each heavy key.
    width = F.expr(f"1 + (hi - lo) div (1 + n div {int(block)})")
    ranges = F.broadcast(ranges.select(_KEY, F.struct("lo", width.alias("width")).alias(_HOT)))
    number = F.call_function("div", at - F.col(_HOT)["lo"], F.col(_HOT)["width"])
    earlier = Window.partitionBy(_KEY).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hot.join(ranges, _KEY)
        .groupBy(_KEY, number.alias("_block"))
        .agg(F.count(F.lit(1)).alias(_ROWS))
        .select(_KEY, "_block", F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias("_offset"))
    )
    dealt = keyed.join(ranges, _KEY, "left").withColumn("_block", F.coalesce(number, F.lit(-1).cast("long")))
    within = F.row_number().over(Window.partitionBy(_KEY, "_block").orderBy(at)).cast("long")
    # The join has the keys of the window, so it moves no row again.
    numbered = dealt.withColumn("_within", within).join(offsets, [_KEY, "_block"], "left")
    return numbered.select(*own, (F.col("_within") + F.coalesce("_offset", F.lit(0))).alias(name))


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: the one with the lowest ``order``.

    Spark limits each key to one row per map task before the shuffle
    (WindowGroupLimit), so a key with many copies arrives as a handful of rows.
    """
    first = Window.partitionBy(*[named(k) for k in keys]).orderBy(named(order))
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def flag_later_copies(
    df: DataFrame, keys: Sequence[str], order: str, name: str, parts: int = HEAVY_PARTS
) -> DataFrame:
    """True on every row of a key but its first."""
    marked = with_key_aggregates(df, keys, {"_first": F.min(named(order))}, parts)
    return marked.withColumn(name, named(order) > F.col("_first")).drop("_first")


def flag_shared_key(df: DataFrame, keys: Sequence[str], name: str, parts: int = HEAVY_PARTS) -> DataFrame:
    """True on every row whose key occurs more than once."""
    marked = with_key_aggregates(df, keys, {"_copies": F.count(F.lit(1))}, parts)
    return marked.withColumn(name, F.col("_copies") > 1).drop("_copies")


def flag_members(
    df: DataFrame, members: DataFrame, keys: Sequence[str], name: str, parts: int = HEAVY_PARTS
) -> DataFrame:
    """True on rows whose key occurs in ``members``, which holds each key once.

    Rows and members meet by key in one shuffle. Rows of heavy keys are dealt by a salt and look their key up in a broadcast
    of the members with a heavy hash, fewer than ``parts``.
    """
    hashes = heavy_hashes(df, keys, parts)
    own = [named(c) for c in df.columns]
    keyed = df.withColumn(_KEY, _struct(keys))
    marks = members.select(_struct(keys).alias(_KEY), F.lit(True).alias(name), _hashed(keys).alias(_HASH))
    if not hashes:
        return keyed.join(marks, _KEY, "left").select(*own, F.coalesce(named(name), F.lit(False)).alias(name))
    heavy = marks.where(F.col(_HASH).isin(hashes)).select(_KEY, F.lit(True).alias(_HOT))
    salt = F.when(_hashed(keys).isin(hashes), _spread(df)).otherwise(0)
    # Key and salt in one struct: Spark would take a salt that is 0 for all members out of the join's keys.
    dealt = keyed.join(F.broadcast(heavy), _KEY, "left").withColumn(_SALT, F.struct(_KEY, salt))
    met = dealt.join(marks.select(F.struct(_KEY, F.lit(0)).alias(_SALT), name), _SALT, "left")
    return met.select(*own, F.coalesce(named(name), F.col(_HOT), F.lit(False)).alias(name))


def count_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``rows``, ``distinct_keys`` and ``copies`` (rows beyond the first of their key)."""
    per_key = df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias(_ROWS))
    return per_key.agg(
        F.coalesce(F.sum(_ROWS), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys")
    ).withColumn("copies", F.col("rows") - F.col("distinct_keys"))
