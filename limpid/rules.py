"""Every value a grade-record check depends on, in one frozen object.

Functions in this package take a ``Rules`` so that other column names, code
sets, ranges or weights can be used without touching the operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Columns:
    """Names of the six business fields and of the row status."""

    year: str = "COD_ANU"
    student: str = "COD_ETU"
    course: str = "COD_ELP"
    grade: str = "NOT_ELP"
    status: str = "COD_TRE"
    session: str = "COD_SES"
    row_status: str = "row_status"

    @property
    def fields(self) -> tuple[str, ...]:
        return (self.year, self.student, self.course, self.grade, self.status, self.session)

    @property
    def record(self) -> tuple[str, ...]:
        return (*self.fields, self.row_status)

    @property
    def key(self) -> tuple[str, ...]:
        return (self.student, self.session, self.course)

    @property
    def pair(self) -> tuple[str, ...]:
        return (self.student, self.course)


# Accepted result codes, one list per place that checks them.
CLEANING_CODES = ("V", "AJ", "RAT", "VAR", "ADM", "NV", "ACAR", "ABSN")
NOTEBOOK_CODES = ("V", "RAT", "VAR", "ADM", "NV", "ACAR", "ABS")

# Texts a delimited file reader treats as a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Texts that stand for "no result code" in the dashboard profile.
NULL_WORDS = ("nan", "None", "NULL")

# Weight of each quality dimension in a global score.
NOTEBOOK_WEIGHTS = {
    "completude": 0.20,
    "validite": 0.20,
    "exactitude": 0.15,
    "coherence": 0.15,
    "unicite": 0.05,
    "distribution": 0.05,
    "schema_integrity": 0.20,
}
DASHBOARD_WEIGHTS = {
    "Complétude": 0.20,
    "Validité": 0.20,
    "Exactitude": 0.15,
    "Cohérence": 0.15,
    "Unicité": 0.05,
    "Distribution": 0.05,
}

# Display order of the dashboard dimensions, global score last.
DASHBOARD_ORDER = (
    "Complétude", "Unicité", "Cohérence", "Validité", "Exactitude", "Distribution", "global_score",
)


@dataclass(frozen=True)
class Rules:
    cols: Columns = field(default_factory=Columns)
    delimiter: str = ","
    # Position of the field that may itself contain one delimiter (a decimal comma).
    decimal_field: int = 3
    status_codes: tuple[str, ...] = CLEANING_CODES
    notebook_codes: tuple[str, ...] = NOTEBOOK_CODES
    passed: str = "V"
    failed: str = "AJ"
    pass_mark: float = 10.0
    grade_range: tuple[float, float] = (0.0, 20.0)
    sessions: tuple[int, int] = (1, 2)
    course_length: int = 8
    century: int = 20
    # YY/YY becomes start-(start + 1) instead of keeping both parts.
    short_year_successor: bool = False
    # A missing result code counts as invalid.
    status_required: bool = False
    year_range: tuple[int, int] = (2000, 2100)
    # Column that numbers the source rows; it decides which duplicate survives.
    order: str = "line_no"
    # As shipped, the notebook profile compares text sessions with numbers, so its
    # session checks never fire. False gives the check that was meant.
    compat: bool = True

    @property
    def width(self) -> int:
        return len(self.cols.fields)


DEFAULT = Rules()
