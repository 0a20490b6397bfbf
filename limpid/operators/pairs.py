"""Session checks per (student, course) pair: a second session needs a first one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.names import named
from limpid.functions.text import to_number
from limpid.operators.keys import HEAVY_PARTS, flag_members, with_key_aggregates
from limpid.rules import DEFAULT, Rules


def _has_session(number: int, rules: Rules) -> Column:
    same = to_number(named(rules.cols.session)) == number
    return F.bool_or(F.coalesce(same, F.lit(False)))


def pairs_without_first(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Distinct pairs that have the second session but not the first.

    The anti join of the two session sets is one grouping: each pair reduces to
    two booleans map-side, so neither set is shuffled row by row.
    """
    first, second = rules.sessions
    pair = [named(c) for c in rules.cols.pair]
    per_pair = df.groupBy(*pair).agg(
        _has_session(first, rules).alias("_first"), _has_session(second, rules).alias("_second")
    )
    return per_pair.where(F.col("_second") & ~F.col("_first")).select(*pair)


def mark_pairs(df: DataFrame, pairs: DataFrame, name: str, rules: Rules = DEFAULT) -> DataFrame:
    """True on rows whose pair is in ``pairs``; null students and courses match each other."""
    return flag_members(df, pairs, rules.cols.pair, name)


def session_presence(df: DataFrame, rules: Rules = DEFAULT, parts: int = HEAVY_PARTS) -> DataFrame:
    """Whether the row's pair has any first (``has_s1``) and any second (``has_s2``) session."""
    first, second = rules.sessions
    found = {"has_s1": _has_session(first, rules), "has_s2": _has_session(second, rules)}
    return with_key_aggregates(df, rules.cols.pair, found, parts)


def flag_second_without_first(
    df: DataFrame, name: str, rules: Rules = DEFAULT, parts: int = HEAVY_PARTS
) -> DataFrame:
    """``pairs_without_first`` and ``mark_pairs`` in one step, without the self join."""
    known = session_presence(df, rules, parts)
    return known.withColumn(name, F.col("has_s2") & ~F.col("has_s1")).drop("has_s1", "has_s2")


def distinct_pairs(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    return df.select(*[named(c) for c in rules.cols.pair]).distinct()
