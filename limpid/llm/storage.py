"""Tables written between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from limpid.sources.shared import new_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes to the shared folder and reads back, so that a lost executor costs no earlier step."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
