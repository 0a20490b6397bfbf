"""Text tests and text-to-number conversions as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's str.strip() and re's \s know.
_SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
_NOT_BLANK = f"[^{_SPACE}]"
BLANK_OR_NULL_WORD = f"^[{_SPACE}]*$|NULL|None"

# Decimal, exponent and infinity forms; no hex, no type suffix, no decimal comma.
_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"

# Optional sign, digits, optional fraction that is cut off; control characters around it.
_INTEGER = r"^[\x00-\x20\x7f]*([+-]?)([0-9]*)(\.[0-9]*)?[\x00-\x20\x7f]*$"


def has_text(c: Column) -> Column:
    """True when the value is not null and holds a non-space character."""
    return F.coalesce(c.cast("string").rlike(_NOT_BLANK), F.lit(False))


def is_missing_text(c: Column) -> Column:
    """True when null, blank, or containing the word NULL or None."""
    return F.coalesce(c.rlike(BLANK_OR_NULL_WORD), F.lit(True))


def null_if(c: Column, tokens: tuple[str, ...]) -> Column:
    """Null when the value is one of ``tokens``."""
    return F.when(~c.isin(*tokens), c)


def to_number(c: Column) -> Column:
    """Double, or null when the text is not a plain number.

    The pattern comes first because a bare cast also takes type suffixes ('12d').
    """
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def to_int(c: Column) -> Column:
    """Integer with the fraction cut off ('1.7' is 1, '.5' is 0), null when not a number."""
    sign, digits = F.regexp_extract(c, _INTEGER, 1), F.regexp_extract(c, _INTEGER, 2)
    padded = F.concat(sign, F.lit("0"), digits)
    return F.when(c.rlike(_INTEGER) & c.rlike("[0-9.]"), padded.try_cast("int"))


def literal_pattern(text: str) -> str:
    """A pattern that matches just this text."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def surplus_fields(line: Column, delimiter: str, width: int) -> Column:
    """What a CSV line holds after its first ``width`` fields, null if it has no more; quotes keep delimiters."""
    mark, first = literal_pattern(delimiter), literal_pattern(delimiter[0])
    field = rf'(?:"(?:[^"\\]|\\.|"")*+"(?:(?!{first}).)*|(?!")(?:(?!{mark}).)*)'
    pattern = rf"(?s)^(?:{field}{mark}){{{width}}}(.*)$"
    return F.when(line.rlike(pattern), F.regexp_extract(line, pattern, 1))


def field_count(c: Column, delimiter: str) -> Column:
    """Number of delimited fields, without building the array."""
    gone = F.replace(c, F.lit(delimiter), F.lit(""))
    return (F.length(c) - F.length(gone)) / len(delimiter) + 1


def percent_text(c: Column, signed: bool = False) -> Column:
    """'12.34%', with a leading + for gains when ``signed``."""
    text = F.when(c.isNotNull(), F.format_string("%.2f%%", c))
    return F.when(c >= 0, F.concat(F.lit("+"), text)).otherwise(text) if signed else text
