"""The rules of each business field, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limpid.functions.text import to_int
from limpid.rules import DEFAULT, Rules

# The three spellings of an academic year.
YEAR_FORMS = {
    "YYYY-YYYY": r"^\d{4}-\d{4}$",
    "YY/YY": r"^\d{2}/\d{2}$",
    "YYYY": r"^\d{4}$",
}
# Fixed value: digits with at most one decimal part, comma or point.
GRADE_FORM = r"^[0-9]+([.,][0-9]+)?$"


def year_form(c: Column) -> Column:
    """Name of the spelling: one of YEAR_FORMS, NULL or INVALID."""
    named = F.coalesce(*[F.when(c.rlike(p), F.lit(name)) for name, p in YEAR_FORMS.items()])
    return F.coalesce(named, F.when(c.isNull(), F.lit("NULL")), F.lit("INVALID"))


def year_corrected(c: Column) -> Column:
    """True for everything that is not already YYYY-YYYY."""
    return year_form(c) != "YYYY-YYYY"


def academic_year(c: Column, rules: Rules = DEFAULT) -> Column:
    """YYYY-YYYY, or null. YYYY gets its successor; YY/YY gets the century on both parts."""
    form = year_form(c)
    century = rules.century
    if rules.short_year_successor:
        expanded = _with_successor(F.concat(F.lit(str(century)), F.substring(c, 1, 2)))
    else:
        expanded = F.regexp_replace(c, r"^(\d{2})/(\d{2})$", f"{century}$1-{century}$2")
    return (
        F.when(form == "YYYY-YYYY", c)
        .when(form == "YYYY", _with_successor(c))
        .when(form == "YY/YY", expanded)
    )


def _with_successor(start: Column) -> Column:
    return F.concat_ws("-", start, (start.try_cast("int") + 1).cast("string"))


def upper_trimmed(c: Column) -> Column:
    return F.upper(F.trim(c))


def course_is_bad(code: Column, rules: Rules = DEFAULT) -> Column:
    """True when a normalised course code is null or not exactly N ASCII letters/digits."""
    exact = r"^[a-zA-Z0-9]{%d}\z" % rules.course_length
    return ~F.coalesce(code.rlike(exact), F.lit(False))


def grade_value(c: Column) -> Column:
    """Double from '14.5' or '14,5'; null for signs, blanks, exponents and open decimals."""
    number = F.regexp_extract(F.trim(c), GRADE_FORM, 0)
    return F.translate(number, ",", ".").try_cast("double")


def grade_out_of_range(grade: Column, rules: Rules = DEFAULT) -> Column:
    low, high = rules.grade_range
    return ~grade.between(low, high)


def grade_incoherent(status: Column, grade: Column, rules: Rules = DEFAULT) -> Column:
    """Passed below the pass mark, or failed at or above it (three-valued)."""
    return ((status == rules.passed) & (grade < rules.pass_mark)) | (
        (status == rules.failed) & (grade >= rules.pass_mark)
    )


def grade_missing_in(grade: Column, session: Column, number: int) -> Column:
    """Grade is null in the given session; null when the session is not a number."""
    return grade.isNull() & (to_int(session) == number)


def status_is_bad(code: Column, rules: Rules = DEFAULT) -> Column:
    """True for a code outside the accepted list; null is accepted unless a status is required."""
    unknown = ~F.coalesce(code.isin(*rules.status_codes), F.lit(False))
    return unknown if rules.status_required else code.isNotNull() & unknown


def session_is_bad(session: Column, rules: Rules = DEFAULT) -> Column:
    """True for a number that is no session; null when there is no number."""
    return ~session.isin(*rules.sessions)
