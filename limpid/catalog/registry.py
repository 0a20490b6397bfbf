"""The register itself: name -> (Spark query, checking SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered already")
    QUERIES[name] = query
    if sql is not None:
        SQL[name] = sql


def six(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that sums taken in another order compare equal."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
