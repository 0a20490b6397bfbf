"""Columns by their exact names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """The column of that name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in float and double columns as null; other columns and their order stay."""
    kinds = (T.FloatType, T.DoubleType)
    if not any(isinstance(f.dataType, kinds) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.nanvl(named(f.name), F.lit(None).cast(f.dataType)).alias(f.name) if isinstance(f.dataType, kinds) else named(f.name)
            for f in df.schema.fields
        ]
    )
