"""From raw lines to records: split, classify, repair, drop the header.

All of it is one narrow projection over the scan; nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.text import field_count, literal_pattern, null_if, surplus_fields, to_number
from limpid.rules import DEFAULT, MISSING_TOKENS, Rules

RAW = "raw_line"


def split_lines(lines: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Add ``parts``: the fields, trailing empty ones kept, quotes not interpreted."""
    return lines.withColumn("parts", F.split(RAW, literal_pattern(rules.delimiter)))


def row_status(parts: Column, rules: Rules = DEFAULT) -> Column:
    """OK for the expected width, FIXED for one field more, else INVALID."""
    width = F.size(parts)
    return (
        F.when(width == rules.width, "OK").when(width == rules.width + 1, "FIXED").otherwise("INVALID")
    )


def repaired_field(parts: Column, status: Column, position: int, rules: Rules = DEFAULT) -> Column:
    """Field at ``position``; in FIXED rows the decimal field is glued back together."""
    at = rules.decimal_field
    if position < at:
        fixed = F.get(parts, F.lit(position))
    elif position == at:
        fixed = F.concat_ws(rules.delimiter, F.slice(parts, at + 1, 2))
    else:
        fixed = F.get(parts, F.lit(position + 1))
    return F.when(status == "OK", F.get(parts, F.lit(position))).when(status == "FIXED", fixed)


def records_from_parts(split: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Name the fields; INVALID rows get nulls. Other columns are carried along."""
    carried = [c for c in split.columns if c not in (RAW, "parts")]
    status = row_status(F.col("parts"), rules)
    named = [
        repaired_field(F.col("parts"), status, i, rules).alias(name)
        for i, name in enumerate(rules.cols.fields)
    ]
    return split.select(*carried, *named, status.alias(rules.cols.row_status))


def parse_lines(lines: DataFrame, rules: Rules = DEFAULT, keep_invalid: bool = False) -> DataFrame:
    """Records without the header line.

    Unparsable lines are dropped unless ``keep_invalid``, which keeps them as
    null records marked INVALID (a quarantine). Both filters look at the raw
    text, so Spark runs them before the split instead of repeating the split.
    """
    raw = F.col(RAW)
    parsable = field_count(raw, rules.delimiter).isin(rules.width, rules.width + 1)
    header = raw.startswith(rules.cols.year + rules.delimiter)
    kept = ~(header & parsable) if keep_invalid else ~header & parsable
    return records_from_parts(split_lines(lines.where(kept), rules), rules)


def drop_header_by_value(records: DataFrame, rules: Rules = DEFAULT, keep_invalid: bool = False) -> DataFrame:
    """Drop rows whose year field is the column name; null years go too unless kept."""
    year = F.col(rules.cols.year)
    return records.where(~year.eqNullSafe(rules.cols.year) if keep_invalid else year != rules.cols.year)


def drop_first_row(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Drop the row with the lowest order value, whatever it holds."""
    first = df.agg(F.min(rules.order)).scalar()
    return df.where(F.col(rules.order) != first)


def ragged_records(lines: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Read each line as CSV onto the six fields plus EXTRA, without any repair.

    Short lines are padded with null, missing-value tokens become null, blank
    lines go. ``too_many_fields`` marks lines that had more than seven fields, and ``surplus`` keeps their rest.
    """
    names = [*rules.cols.fields, "EXTRA"]
    carried = [c for c in lines.columns if c != RAW]
    schema = ", ".join(f"`{n}` string" for n in [*names, "_more"])
    surplus = surplus_fields(F.col(RAW), rules.delimiter, len(names))
    row = F.from_csv(RAW, schema, {"sep": rules.delimiter})
    return (
        lines.where(F.col(RAW).rlike(r"\S"))
        .withColumn("_row", row)
        .select(
            *carried,
            *[null_if(F.col(f"_row.`{n}`"), MISSING_TOKENS).alias(n) for n in names],
            surplus.isNotNull().alias("too_many_fields"),
            surplus.alias("surplus"),
        )
    )


def coerce_numeric(ragged: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Year, student and session as numbers, plus the numeric grade in its own column."""
    c = rules.cols
    return ragged.withColumns(
        {
            **{n: to_number(F.col(n)) for n in (c.year, c.student, c.session)},
            f"{c.grade}_NUM": to_number(F.col(c.grade)),
        }
    )
