"""The rows behind a score: invalid, incomplete, duplicate, out-of-list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.names import named
from limpid.functions.text import to_number
from limpid.operators.keys import flag_shared_key
from limpid.rules import DEFAULT, Rules


def invalid_sessions(ragged: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Rows whose session is not one of the session numbers; missing sessions are listed too."""
    session = F.col(rules.cols.session).cast("string")
    return ragged.where(~F.coalesce(session.isin(*[str(s) for s in rules.sessions]), F.lit(False)))


def structural_anomalies(ragged: DataFrame) -> DataFrame:
    """Rows with a seventh field."""
    return ragged.where(F.col("EXTRA").isNotNull())


def of_session(records: DataFrame, session: int, rules: Rules = DEFAULT) -> DataFrame:
    """Rows of one session, whether it is written 2 or 2.0."""
    return records.where(to_number(named(rules.cols.session)) == session)


def invalid_rows(records: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    return records.where(F.col(rules.cols.row_status) == "INVALID")


def incomplete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a null or NaN in any of ``columns``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    missing = lambda c: named(c).isNull() | F.isnan(named(c)) if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else named(c).isNull()
    tests = [missing(c) for c in (columns or df.columns)]
    return df.where(reduce(lambda a, b: a | b, tests))


def first_incomplete_rows(df: DataFrame, order: str, limit: int) -> DataFrame:
    """The first ``limit`` incomplete rows, each with the count of all of them."""
    found = incomplete_rows(df)
    total = found.agg(F.count(F.lit(1))).scalar()
    return found.orderBy(named(order)).limit(limit).withColumn("incomplete_rows", total)


def duplicate_members(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All members of duplicate groups, sorted by those ``keys`` the table has, nulls last."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.limit(0)
    shared = flag_shared_key(df, present, "_shared").where("_shared").drop("_shared")
    return sort_by_keys(shared, present, order)


def sort_by_keys(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Sorted by the keys with nulls last; ``order`` breaks ties, so a common key splits by range."""
    return df.orderBy(*[named(k).asc_nulls_last() for k in keys], named(order))
