"""The cleaning job over ingested records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.functions import fields as ff
from limpid.operators import cleaners as cl
from limpid.operators.keys import keep_first
from limpid.rules import DEFAULT, Rules

# Order of the cleaned columns after the seven record columns.
FLAGS = (
    "elp_invalid_format", "note_missing_s1", "note_missing_s2", "note_out_of_range",
    "note_incoherent", "cod_tre_invalid", "cod_ses_missing", "cod_ses_invalid",
)


def clean_records(records: DataFrame, rules: Rules = DEFAULT, carry: Sequence[str] = ()) -> DataFrame:
    """All six cleaners with one shuffle: the seven record columns and eight flags.

    Applied one after the other, the cleaners remove copies twice: on the key as read,
    and again after course codes were normalised. The second key is coarser and
    both keep the lowest order value, so the second step alone keeps the same
    rows. It runs on the raw fields, before the flags widen the row.
    """
    survivors = keep_first(cl.clean_course(records, rules), rules.cols.key, rules.order)
    flagged = cl.grade_flags(cl.clean_year(survivors, rules), rules)
    done = cl.clean_session(cl.clean_status(flagged, rules), rules)
    return done.select(*carry, *rules.cols.record, *FLAGS)


def error_flags(records: DataFrame, rules: Rules = DEFAULT, carry: Sequence[str] = ()) -> DataFrame:
    """The cleaned row and its flags without removing copies: one narrow projection."""
    flagged = cl.grade_flags(cl.clean_year(cl.clean_course(records, rules), rules), rules)
    done = cl.clean_session(cl.clean_status(flagged, rules), rules)
    return done.select(*carry, *rules.cols.record, *FLAGS)


def with_parse_status(records: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Keep how the line was parsed: FLAGGED overwrites row_status later."""
    return records.withColumn("parse_status", F.col(rules.cols.row_status))


def year_audit(records: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Cleaned records next to the year as read, for ``year_metrics``."""
    year = rules.cols.year
    return records.withColumns({"year_read": F.col(year), year: ff.academic_year(F.col(year), rules)})
