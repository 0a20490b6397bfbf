"""Quality scores in three profiles, each as aggregate expressions over one pass.

* notebook profile (``*_n``): shares in 0..1 over parsed, uncleaned records;
* dashboard profile (``*_d``): percentages over ingested or cleaned records;
* exploration profile (``*_e``): rounded percentages over the ragged table.

A whole score row reads its table twice: once for all plain rates and the share of
each session, counted per session, and once for uniqueness and the pair rule, counted
per (student, course, session). Both shrink hot keys map-side, and the second reads the
key columns only. ``by`` scores batches instead of the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.names import named
from limpid.functions.text import BLANK_OR_NULL_WORD, has_text, null_if, to_number
from limpid.operators.keys import count_copies
from limpid.operators.quantiles import quantiles
from limpid.rules import (
    DASHBOARD_WEIGHTS,
    DEFAULT,
    NOTEBOOK_WEIGHTS,
    NULL_WORDS,
    Rules,
)

def _rows() -> Column:
    return F.count(F.lit(1))


def _present(df: DataFrame, name: str) -> Column:
    """Neither null nor, in a column of floating numbers, NaN."""
    there = named(name).isNotNull()
    return there & ~F.isnan(named(name)) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else there


def _per_column(df: DataFrame, columns: Sequence[str], percent: Sequence[Column]) -> DataFrame:
    """(column_name, pct, mean_pct) of aggregates, one for each column; names may hold any characters."""
    wide = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(percent)])
    cells = [F.col(f"_{i}") for i in range(len(columns))]
    mean = reduce(lambda a, b: a + b, cells) / len(columns)
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), x.alias("pct"), mean.alias("mean_pct")) for c, x in zip(columns, cells)]))
    )


def _share(test: Column) -> Column:
    """Share of rows where ``test`` is true; null tests count as false, no rows give null."""
    return F.try_divide(F.count_if(test).cast("double"), _rows())


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def _combine(frames: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """One frame from frames with one row each, or one row per batch each."""
    first, *rest = frames
    if by:
        for frame in rest:
            other = frame.withColumnsRenamed({k: f"_{k}" for k in by})
            same = reduce(lambda a, b: a & b, [first[k].eqNullSafe(other[f"_{k}"]) for k in by])
            first = first.join(other, same, "left").drop(*[f"_{k}" for k in by])
        return first
    for i, frame in enumerate(rest):
        row = frame.select(F.struct(*frame.columns)).scalar()
        first = first.withColumn(f"_{i}", row).select("*", f"_{i}.*").drop(f"_{i}")
    return first


# --- notebook profile -------------------------------------------------------------------


def completeness_n(columns: Sequence[str]) -> Column:
    """Non-blank cells over all cells."""
    filled = reduce(lambda a, b: a + b, [F.count_if(has_text(named(c))) for c in columns])
    return _ratio(filled, _rows() * len(columns))


def grade_absent(rules: Rules = DEFAULT) -> Column:
    """A result code without a grade."""
    return F.col(rules.cols.status).isNotNull() & F.col(rules.cols.grade).isNull()


def validity_n(rules: Rules = DEFAULT) -> Column:
    session, status = F.col(rules.cols.session), F.col(rules.cols.status)
    known = session.isin(*[str(s) for s in rules.sessions])
    return _share(known & (status.isin(*rules.notebook_codes) | status.isNull()))


def format_n(rules: Rules = DEFAULT) -> Column:
    year, course = F.col(rules.cols.year), F.col(rules.cols.course)
    # A missing text compares as the word None there, which is no year anyway.
    return _share(year.rlike(r"^\d{4}$") & course.rlike(r"^[A-Z0-9]+$"))


def accuracy_n(rules: Rules = DEFAULT) -> Column:
    return _share(to_number(F.col(rules.cols.grade)).between(*rules.grade_range))


def schema_integrity_n(rules: Rules = DEFAULT) -> Column:
    return _share(~F.col(rules.cols.row_status).eqNullSafe("FIXED"))


def session_balance_n(rules: Rules = DEFAULT) -> Column:
    """1 − |share of first − share of second| over non-null sessions; 1 in compat mode."""
    session = F.col(rules.cols.session)
    if rules.compat:
        # Looking up numbers among text values finds neither session.
        return F.when(_rows() >= 0, F.lit(1.0))
    first, second = (F.count_if(session == str(s)) for s in rules.sessions)
    known = F.count(session)
    return 1 - F.abs(_ratio(first, known) - _ratio(second, known))


def uniqueness(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """One row with ``score``: distinct keys over rows, on the key columns the table has."""
    keys = [k for k in rules.cols.key if k in df.columns]
    if not keys:
        return df.agg(F.when(_rows() >= 0, F.lit(1.0)).alias("score"))
    counted = count_copies(df, keys)
    return counted.select((1 - _ratio(F.col("copies"), F.col("rows"))).alias("score"))


def _pair_counts(df: DataFrame, rules: Rules, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and incoherent rows, counted per key, then per pair, then in all."""
    c = rules.cols
    first, second = rules.sessions
    per_key = df.groupBy(*by, *c.key).agg(
        _rows().alias("n"), F.count_if(grade_absent(rules)).alias("absent")
    )
    number = to_number(F.col(c.session))
    per_pair = per_key.groupBy(*by, *c.pair).agg(
        F.sum("n").alias("n"),
        F.sum("absent").alias("absent"),
        _rows().alias("keys"),
        F.bool_or(F.coalesce(number == first, F.lit(False))).alias("s1"),
        F.bool_or(F.coalesce(number == second, F.lit(False))).alias("s2"),
    )
    lonely = F.col("s2") & ~F.col("s1")
    bad = F.when(lonely, F.col("n")).otherwise(F.col("absent"))
    return per_pair.groupBy(*by).agg(
        F.sum("n").alias("pair_rows"), F.sum("keys").alias("distinct_keys"), F.sum(bad).alias("incoherent")
    )


def coherence_n(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """1 − share of rows with an absent grade, or with a second session lacking a first.

    In compat mode the second rule never fires, as shipped.
    """
    if rules.compat:
        return df.agg((1 - _share(grade_absent(rules))).alias("score"))
    counted = _pair_counts(df, rules)
    return counted.select((1 - _ratio(F.col("incoherent"), F.col("pair_rows"))).alias("score"))


def outlier_score_n(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """1 − share of numeric grades outside the quartiles widened by 1.5 interquartile ranges."""
    grades = df.select(to_number(F.col(rules.cols.grade)).alias("x")).where("x is not null")
    q = quantiles(grades, "x", [0.25, 0.75]).select(F.struct("q0", "q1")).scalar()
    reach = 1.5 * (F.col("q.q1") - F.col("q.q0"))
    outside = (F.col("x") < F.col("q.q0") - reach) | (F.col("x") > F.col("q.q1") + reach)
    return grades.withColumn("q", q).agg((1 - _share(outside)).alias("score"))


def scores_n(df: DataFrame, rules: Rules = DEFAULT, helpers: Sequence[str] = ()) -> DataFrame:
    """One row: the seven notebook dimensions and ``global_score``, from two reads."""
    columns = [c for c in df.columns if c not in helpers]
    plain = df.agg(
        completeness_n(columns).alias("completude"),
        validity_n(rules).alias("validite"),
        accuracy_n(rules).alias("exactitude"),
        session_balance_n(rules).alias("distribution"),
        schema_integrity_n(rules).alias("schema_integrity"),
        (1 - _share(grade_absent(rules))).alias("without_grade"),
    )
    if rules.compat:
        row = _combine([plain.withColumnRenamed("without_grade", "coherence"), uniqueness(df, rules).withColumnRenamed("score", "unicite")], ())
    else:
        # Uniqueness comes with the count of pairs.
        keyed = _pair_counts(df, rules).select(
            (1 - _ratio(F.col("incoherent"), F.col("pair_rows"))).alias("coherence"),
            (1 - _ratio(F.col("pair_rows") - F.col("distinct_keys"), F.col("pair_rows"))).alias("unicite"),
        )
        row = _combine([plain, keyed], ())
    order = ["completude", "unicite", "coherence", "validite", "exactitude", "distribution", "schema_integrity"]
    total = reduce(lambda a, b: a + b, [F.col(k) * w for k, w in NOTEBOOK_WEIGHTS.items()])
    return row.select(*order).withColumn("global_score", total)


# --- dashboard profile ------------------------------------------------------------------


def _filled(df: DataFrame, name: str) -> Column:
    """Rows whose cell of that column is not missing; word tests apply to text only."""
    there = _present(df, name)
    if isinstance(df.schema[name].dataType, T.StringType):
        there &= ~named(name).rlike(BLANK_OR_NULL_WORD)
    return F.count_if(there)


def _percent(part: Column, rows: Column) -> Column:
    return F.try_divide(part.cast("double"), rows) * 100


def completeness_d(df: DataFrame, helpers: Sequence[str] = ()) -> DataFrame:
    """(column_name, pct, mean_pct): completeness per column and its mean over all columns; NaN is missing."""
    columns = [c for c in df.columns if c not in helpers]
    return _per_column(df, columns, [_percent(_filled(df, c), _rows()) for c in columns])


def _valid(df: DataFrame, rules: Rules) -> Column | None:
    """Session is 1 or 2 once a trailing .0 is gone, and the code is known or missing."""
    c = rules.cols
    if c.session not in df.columns or c.status not in df.columns:
        return None
    session = F.regexp_replace(F.col(c.session).cast("string"), r"\.0$", "")
    status = null_if(F.col(c.status).cast("string"), NULL_WORDS)
    known = status.isin(*rules.status_codes) | status.isNull()
    return session.isin(*[str(s) for s in rules.sessions]) & known


def validity_d(df: DataFrame, rules: Rules = DEFAULT) -> Column:
    """% of rows with a valid session and code; 0 without these columns."""
    test = _valid(df, rules)
    return F.when(_rows() >= 0, F.lit(0.0)) if test is None else _share(test) * 100


def coherence_d(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """% of coherent rows; 100 for an empty table; only the grade rule without key columns."""
    if not set(rules.cols.key) <= set(df.columns):
        return df.agg((100 * (1 - F.coalesce(_share(grade_absent(rules)), F.lit(0.0)))).alias("score"))
    return _pair_counts(df, rules).select(_coherence_d().alias("score"))


def _coherence_d() -> Column:
    return 100 * (1 - F.coalesce(_ratio(F.col("incoherent"), F.col("pair_rows")), F.lit(0.0)))


def distribution_d(df: DataFrame, column: str | None = None, rules: Rules = DEFAULT, by: Sequence[str] = ()) -> DataFrame:
    """Entropy of the values in % of the most it could be; one value 100, none 0."""
    name = column or rules.cols.session
    if name not in df.columns:
        return df.groupBy(*by).agg(F.when(_rows() >= 0, F.lit(100.0)).alias("score"))
    counts = df.groupBy(*by, name).agg(_rows().alias("n"))
    return counts.groupBy(*by).agg(_entropy_d(F.when(F.col(name).isNotNull(), F.col("n"))).alias("score"))


def _entropy_d(n: Column) -> Column:
    """Entropy in % of counts ``n``, one row per value."""
    k = F.count(n)
    entropy = F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)
    return F.when(k == 0, 0.0).when(k == 1, 100.0).otherwise(100 * entropy / F.log2(k))


def schema_integrity_d(df: DataFrame, rules: Rules = DEFAULT) -> Column:
    """% of rows that parsed; 100 without a row status."""
    if rules.cols.row_status not in df.columns:
        return F.when(_rows() >= 0, F.lit(100.0))
    return _share(~F.col(rules.cols.row_status).eqNullSafe("INVALID")) * 100


def _plain_d(df: DataFrame, columns: Sequence[str], rules: Rules, by: Sequence[str]) -> DataFrame:
    """(by…, rows, complete, valid, schema, spread) from one read: counts per session, added up."""
    c = rules.cols
    keys = [*by, c.session] if c.session in df.columns else list(by)
    valid = _valid(df, rules)
    tests = {
        "_n": _rows(),
        "_valid": F.count_if(valid) if valid is not None else F.lit(None).cast("long"),
        "_schema": F.count_if(~F.col(c.row_status).eqNullSafe("INVALID")) if c.row_status in df.columns else F.lit(None).cast("long"),
        **{f"_{i}": _filled(df, name) for i, name in enumerate(columns)},
    }
    counts = df.groupBy(*keys).agg(*[x.alias(n) for n, x in tests.items()])
    rows = F.sum("_n")
    complete = reduce(lambda a, b: a + b, [_percent(F.sum(f"_{i}"), rows) for i in range(len(columns))]) / len(columns)
    spread = _entropy_d(F.when(F.col(c.session).isNotNull(), F.col("_n"))) if c.session in df.columns else F.max(F.lit(100.0))
    return counts.groupBy(*by).agg(
        F.coalesce(rows, F.lit(0)).alias("rows"),
        complete.alias("complete"),
        (_percent(F.sum("_valid"), rows) if valid is not None else F.coalesce(F.max(F.lit(0.0)), F.lit(0.0))).alias("valid"),
        (_percent(F.sum("_schema"), rows) if c.row_status in df.columns else F.coalesce(F.max(F.lit(100.0)), F.lit(100.0))).alias("schema"),
        F.coalesce(spread, F.lit(100.0)).alias("spread"),
    )


def scores_d(
    df: DataFrame,
    rules: Rules = DEFAULT,
    helpers: Sequence[str] = (),
    by: Sequence[str] = (),
    with_schema: bool = False,
    renormalize: bool = False,
    with_rows: bool = False,
) -> DataFrame:
    """One row (per batch): the six dashboard dimensions to two digits and ``global_score``, from two reads.

    The weights add up to 0.80, so 80 is the maximum; ``renormalize`` divides by
    their sum. ``with_schema`` adds the seventh dimension with its weight of 0.20, ``with_rows`` the number of ``rows``.
    """
    columns = [c for c in df.columns if c not in helpers and c not in by]
    row = _combine([_plain_d(df, columns, rules, by), _pair_counts(df, rules, by)], by)
    two = lambda c: F.round(c, 2)
    scored = row.select(
        *by,
        *(["rows"] if with_rows else []),
        two(F.col("complete")).alias("Complétude"),
        two(100 * _ratio(F.col("distinct_keys"), F.col("pair_rows"))).alias("Unicité"),
        two(_coherence_d()).alias("Cohérence"),
        two(F.col("valid")).alias("Validité"),
        two(F.col("valid")).alias("Exactitude"),
        two(F.col("spread")).alias("Distribution"),
        *([two(F.col("schema")).alias("Intégrité Schéma")] if with_schema else []),
    )
    return scored.withColumn("global_score", global_score_d(with_schema, renormalize))


def global_score_d(with_schema: bool = False, renormalize: bool = False) -> Column:
    """Weighted sum of the dashboard dimensions to two digits, from a row that has them."""
    weights = dict(DASHBOARD_WEIGHTS)
    if with_schema:
        weights["Intégrité Schéma"] = 0.20
    total = reduce(
        lambda a, b: a + b, [F.coalesce(F.col(k), F.lit(0.0)) * w for k, w in weights.items()]
    )
    return F.round(total / sum(weights.values()) if renormalize else total, 2)


# --- exploration profile ----------------------------------------------------------------


def _two_e(c: Column) -> Column:
    return F.bround(c, 2)


def completeness_e(df: DataFrame, helpers: Sequence[str] = ()) -> DataFrame:
    """(column_name, pct, mean_pct): non-missing share per column to two digits, and the mean; NaN is missing."""
    columns = [c for c in df.columns if c not in helpers]
    return _per_column(df, columns, [_two_e(_share(_present(df, c)) * 100) for c in columns])


def _grade_e(rules: Rules) -> Column:
    return F.col(f"{rules.cols.grade}_NUM")


def accuracy_e(rules: Rules = DEFAULT) -> Column:
    hits = F.count_if(F.col(rules.cols.session).isin(*rules.sessions)) + F.count_if(
        _grade_e(rules).between(*rules.grade_range)
    )
    return _two_e(_ratio(hits, 2 * _rows()) * 100)


def coherence_e(rules: Rules = DEFAULT) -> Column:
    return _two_e((1 - _share((F.col(rules.cols.status) == rules.passed) & _grade_e(rules).isNull())) * 100)


def validity_e(rules: Rules = DEFAULT) -> Column:
    hits = F.count_if(F.col(rules.cols.year).between(*rules.year_range)) + F.count(F.col(rules.cols.student))
    return _two_e(_ratio(hits, 2 * _rows()) * 100)


def extreme_values_e(rules: Rules = DEFAULT) -> Column:
    return _two_e((1 - _share(~_grade_e(rules).between(*rules.grade_range))) * 100)


def session_share_e(rules: Rules = DEFAULT) -> Column:
    return _two_e(_share(F.col(rules.cols.session).isin(*rules.sessions)) * 100)


def uniqueness_e(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    counted = count_copies(df, rules.cols.key)
    score = _two_e(_ratio(F.col("distinct_keys"), F.col("rows")) * 100)
    return counted.select(score.alias("score"))


def scores_e(df: DataFrame, rules: Rules = DEFAULT, helpers: Sequence[str] = ()) -> DataFrame:
    """One row: the seven exploration values and their plain mean as ``global_score``."""
    columns = [c for c in df.columns if c not in helpers]
    rates = [_two_e(_share(_present(df, c)) * 100) for c in columns]
    plain = df.agg(
        (reduce(lambda a, b: a + b, rates) / len(columns)).alias("completeness"),
        accuracy_e(rules).alias("accuracy"),
        coherence_e(rules).alias("consistency"),
        validity_e(rules).alias("validity_format"),
        extreme_values_e(rules).alias("extreme_values"),
        session_share_e(rules).alias("session_distribution"),
    )
    row = _combine([plain, uniqueness_e(df, rules).withColumnRenamed("score", "uniqueness")], ())
    order = [
        "completeness", "accuracy", "consistency", "uniqueness", "validity_format", "extreme_values",
        "session_distribution",
    ]
    mean = reduce(lambda a, b: a + b, [F.col(c) for c in order]) / len(order)
    return row.select(*order).withColumn("global_score", _two_e(mean))
