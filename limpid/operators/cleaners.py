"""One cleaner per field. Each takes records and returns records with its flags.

A cleaner is any ``DataFrame -> DataFrame`` function; ``run_cleaners`` applies a list of
them in order. Counts that describe a cleaner's effect are separate one-row
aggregates (``*_metrics``), so cleaning itself triggers no job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions import fields as ff
from limpid.functions.text import to_int
from limpid.operators.keys import keep_first
from limpid.rules import DEFAULT, Rules

Cleaner = Callable[[DataFrame], DataFrame]


def ensure_row_status(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Add row_status = OK where the table has no such column."""
    name = rules.cols.row_status
    return df if name in df.columns else df.withColumn(name, F.lit("OK"))


def business_projection(df: DataFrame, rules: Rules = DEFAULT, carry: Iterable[str] = ()) -> DataFrame:
    """Only the seven record columns, and those named in ``carry``."""
    return df.select(*carry, *rules.cols.record)


def _flagged(df: DataFrame, bad: Column, rules: Rules) -> DataFrame:
    status = rules.cols.row_status
    return ensure_row_status(df, rules).withColumn(
        status, F.when(bad, F.lit("FLAGGED")).otherwise(F.col(status))
    )


def clean_year(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    year = rules.cols.year
    return df.withColumn(year, ff.academic_year(F.col(year), rules))


def flag_missing_student(df: DataFrame, name: str, rules: Rules = DEFAULT) -> DataFrame:
    """True on rows without a student."""
    return df.withColumn(name, F.col(rules.cols.student).isNull())


def clean_student(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Keep the first row of each (student, session, course)."""
    return keep_first(df, rules.cols.key, rules.order)


def normalise_course(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    course = rules.cols.course
    return df.withColumn(course, ff.upper_trimmed(F.col(course)))


def clean_course(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    course = rules.cols.course
    flagged = normalise_course(df, rules).withColumn(
        "elp_invalid_format", ff.course_is_bad(F.col(course), rules)
    )
    return flagged.withColumn(course, F.when(~F.col("elp_invalid_format"), F.col(course)))


def grade_flags(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Grade as a number, with its four flags; sees session and status as they came in."""
    c = rules.cols
    grade, session = F.col(c.grade), F.col(c.session)
    first, second = rules.sessions
    return df.withColumn(c.grade, ff.grade_value(grade)).withColumns(
        {
            "note_missing_s1": ff.grade_missing_in(grade, session, first),
            "note_missing_s2": ff.grade_missing_in(grade, session, second),
            "note_out_of_range": ff.grade_out_of_range(grade, rules),
            "note_incoherent": ff.grade_incoherent(F.col(c.status), grade, rules),
        }
    )


def clean_grade(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Grade flags, then the key again: nulled course codes may have created new copies."""
    return keep_first(grade_flags(df, rules), rules.cols.key, rules.order)


def clean_status(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    status = rules.cols.status
    marked = df.withColumn(status, ff.upper_trimmed(F.col(status))).withColumn(
        "cod_tre_invalid", ff.status_is_bad(F.col(status), rules)
    )
    bad = F.col("cod_tre_invalid")
    return _flagged(marked.withColumn(status, F.when(~bad, F.col(status))), bad, rules)


def clean_session(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    session = rules.cols.session
    marked = df.withColumn(session, to_int(F.col(session).cast("string"))).withColumns(
        {
            "cod_ses_missing": F.col(session).isNull(),
            "cod_ses_invalid": ff.session_is_bad(F.col(session), rules),
        }
    )
    valid = marked.withColumn(session, F.when(F.col(session).isin(*rules.sessions), F.col(session)))
    return _flagged(valid, F.col("cod_ses_missing") | F.col("cod_ses_invalid"), rules)


CLEANERS: tuple[Cleaner, ...] = (
    clean_year, clean_student, clean_course, clean_grade, clean_status, clean_session,
)


def run_cleaners(df: DataFrame, cleaners: Iterable[Cleaner] = CLEANERS) -> DataFrame:
    """Apply cleaners in order; add your own to the list to extend the job."""
    for cleaner in cleaners:
        df = df.transform(cleaner)
    return df


def _rate(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def year_metrics(cleaned: DataFrame, original: str, rules: Rules = DEFAULT) -> DataFrame:
    """One row: total, null rate and invalid rate of the cleaned year, corrected rows.

    ``original`` names the column that still holds the year as read.
    """
    year, n = F.col(rules.cols.year), F.count(F.lit(1))
    off_form = ~year.rlike(ff.YEAR_FORMS["YYYY-YYYY"])
    return cleaned.agg(
        n.alias("total_rows"),
        F.coalesce(_rate(F.count_if(year.isNull()), n), F.lit(0.0)).alias("null_rate"),
        F.coalesce(_rate(F.count_if(off_form), n), F.lit(0.0)).alias("invalid_rate"),
        F.count_if(ff.year_corrected(F.col(original))).alias("corrected_rows"),
    )


def student_metrics(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """One row: null students, their rate, copies removed, rows before and after.

    Counted per key first, so nothing but one row per key and task is shuffled.
    """
    student = F.col(rules.cols.student)
    per_key = df.groupBy(*rules.cols.key).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n"), F.lit(0))
    nulls = F.coalesce(F.sum(F.when(student.isNull(), F.col("_n"))), F.lit(0))
    return per_key.agg(
        nulls.alias("nulls_cod_etu"),
        F.coalesce(_rate(nulls, before), F.lit(0.0)).alias("null_rate_cod_etu"),
        (before - F.count(F.lit(1))).alias("business_duplicates_removed"),
        before.alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )


def flag_metrics(df: DataFrame, flag: str) -> DataFrame:
    """One row: how many rows carry the flag, and which share; null share when empty."""
    hits = F.count_if(F.col(flag))
    return df.agg(hits.alias("invalid_count"), _rate(hits, F.count(F.lit(1))).alias("invalid_rate"))


def session_metrics(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count_if("cod_ses_missing").alias("missing_count"),
        F.count_if("cod_ses_invalid").alias("invalid_count"),
    )


def cleaning_counts(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """All row-level counts and rates of a cleaning run over ingested records, in one pass."""
    c, n = rules.cols, F.count(F.lit(1))
    year, session = ff.academic_year(F.col(c.year), rules), to_int(F.col(c.session))
    checks = {
        "year_null": year.isNull(),
        "year_off_form": ~year.rlike(ff.YEAR_FORMS["YYYY-YYYY"]),
        "year_corrected": ff.year_corrected(F.col(c.year)),
        "student_null": F.col(c.student).isNull(),
        "course_invalid": ff.course_is_bad(ff.upper_trimmed(F.col(c.course)), rules),
        "status_invalid": ff.status_is_bad(ff.upper_trimmed(F.col(c.status)), rules),
        "session_missing": session.isNull(),
        "session_invalid": ff.session_is_bad(session, rules),
    }
    return df.agg(
        n.alias("total_rows"),
        *[F.count_if(test).alias(f"{name}_count") for name, test in checks.items()],
        *[_rate(F.count_if(test), n).alias(f"{name}_rate") for name, test in checks.items()],
    )

