"""A key of rows whose doc_id may be missing or repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of doc_id and text, never null; null text counts as empty. Only copies share it."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit("")))))
