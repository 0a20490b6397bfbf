"""Connected components of links between integer ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.storage import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. Each id ties its (larger, or smaller) neighbours to the smallest id it sees.

    The smallest id is one row per id, made map-side first; the join's other side may be skewed and is split by AQE.
    """
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        return sides.filter("b > a").join(least, "a").select(F.col("root").alias("a"), "b").filter("a < b").distinct()
    least = edges.groupBy("b").agg(F.min("a").alias("root"))
    tied = edges.join(least, "b").select(F.col("root").alias("a"), F.col("a").alias("b"))
    return tied.unionByName(least.select(F.col("root").alias("a"), "b")).filter("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in the links (a, b); component is the smallest id that can be reached.

    Links to oneself and repeated links don't matter; an empty table gives an empty table.
    """
    edges = stored(
        links.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).filter("a < b").distinct(), "links"
    )
    sign = None
    while True:
        edges = stored(_star(_star(edges, large=True), large=False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign = now
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    )
