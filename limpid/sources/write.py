"""Writers. Row counts come from the write itself, not from a second job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from limpid.functions.names import named
from limpid.sources.shared import exists


def write_parquet(df: DataFrame, path: str, legacy: bool = False, codec: str = "snappy", rows_per_file: int = 0) -> int:
    """Replace ``path`` with the rows of ``df``; returns how many there were.

    ``rows_per_file`` (0: no bound) keeps files short. Spark deals a table to the tasks of a later read by bytes, each file
    counted with the cost of opening it: well compressed rows in large files make few tasks with very many rows.

    ``legacy`` writes the older Parquet layout some readers need. Spark knows that layout only as a setting of the
    session, which changes for the time of such a write; other writes leave the session alone.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = counted.write.mode("overwrite").option("compression", codec).option("maxRecordsPerFile", rows_per_file)
    if not legacy:
        out.parquet(path)
        return seen.get["rows"]
    setting = "spark.sql.parquet.writeLegacyFormat"
    spark = df.sparkSession
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        out.parquet(path)
    finally:
        spark.conf.set(setting, before)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> int:
    """Replace ``path`` with header CSV files; returns the row count."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    return seen.get["rows"]


def append_history(rows: DataFrame, path: str, batch: str | None = None) -> bool:
    """Add score rows to the history table, creating it when absent; new columns are allowed.

    With the id of a ``batch`` the call may be repeated: rows carry it as ``batch_id``, and rows of a batch that is there
    already are not written again. A write that fails leaves nothing, as its files appear together when it ends.
    Returns whether rows were written.
    """
    if batch is not None:
        spark = rows.sparkSession
        if exists(spark, path):
            history = spark.read.option("mergeSchema", True).parquet(path)
            if "batch_id" in history.columns and not history.where(F.col("batch_id") == batch).isEmpty():
                return False
        rows = rows.withColumn("batch_id", F.lit(batch))
    rows.write.mode("append").parquet(path)
    return True


def preview(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first ``n`` rows in source order."""
    return df.orderBy(named(order)).limit(n)
