"""One query per scalar function, over all ingested records (or lines)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from limpid.catalog import frames as fr
from limpid.catalog.registry import add, six
from limpid.catalog.sql import TOKENS, grade, integer, num, sql
from limpid.functions import fields as ff
from limpid.functions import text as ft
from limpid.operators.parsing import split_lines
from limpid.operators.quantiles import quantiles
from limpid.plans import history
from limpid.rules import MISSING_TOKENS


def _scalar(name: str, column: Callable[[], Column], expression: str) -> None:
    """Register ``column`` over the ingested records; built late, when a session exists."""
    add(
        name,
        lambda s, d: six(fr.ingested(s, d).select("line_no", column().alias("value"))),
        sql(f"select line_no, {expression} as value from ingested"),
    )


def _of_parts(name: str, column: Callable[[], Column], expression: str) -> None:
    """Register ``column`` over the split lines."""
    add(
        name,
        lambda s, d: split_lines(fr.lines(s, d)).select("line_no", column().alias("value")),
        sql(f"select line_no, {expression} as value from parts"),
    )


_scalar("trim", lambda: F.trim("COD_ELP"), "trim(COD_ELP)")
_scalar("upper", lambda: F.upper("COD_ELP"), "upper(COD_ELP)")
_scalar("length", lambda: F.length("COD_ELP"), "cast(length(COD_ELP) as int)")
_scalar("regex_match", lambda: F.col("COD_ANU").rlike(r"^\d{4}$"), r"regexp_matches(COD_ANU, '^\d{4}$')")
_scalar("regex_replace", lambda: F.regexp_replace("COD_SES", r"\.0$", ""), r"regexp_replace(COD_SES, '\.0$', '')")
_scalar(
    "null_if_tokens",
    lambda: ft.null_if(F.col("COD_TRE"), MISSING_TOKENS),
    f"case when not list_contains({TOKENS}, COD_TRE) then COD_TRE end",
)
_scalar("null_if_pattern", lambda: F.when(~ft.is_missing_text(F.col("COD_TRE")), F.col("COD_TRE")),
        r"case when not regexp_matches(COD_TRE, '^\s*$|NULL|None') then COD_TRE end")
_scalar("strip_blank_test", lambda: ft.has_text(F.col("COD_TRE")), r"regexp_matches(COD_TRE, '\S')")
_scalar("substring", lambda: F.substring("COD_ANU", 1, 2), "substring(COD_ANU, 1, 2)")
_scalar("concat", lambda: F.concat("COD_ETU", F.lit("-"), "COD_ELP"), "COD_ETU || '-' || COD_ELP")
_scalar("concat_ws", lambda: F.concat_ws(",", "COD_ETU", ff.grade_value(F.col("NOT_ELP")).cast("string")),
        f"concat_ws(',', COD_ETU, cast({grade('NOT_ELP')} as varchar))")
_scalar("cast_double", lambda: ff.grade_value(F.col("NOT_ELP")), grade("NOT_ELP"))
_scalar("cast_int", lambda: ft.to_int(F.col("NOT_ELP")), integer("NOT_ELP"))
_scalar("cast_string", lambda: ft.to_number(F.col("NOT_ELP")).cast("string"), f"cast({num('NOT_ELP')} as varchar)")
_scalar("to_numeric", lambda: ft.to_number(F.col("NOT_ELP")), num("NOT_ELP"))
_scalar(
    "when_otherwise",
    lambda: F.when(F.col("COD_TRE") == "V", "passed").when(F.col("COD_TRE") == "AJ", "failed").otherwise("other"),
    "case COD_TRE when 'V' then 'passed' when 'AJ' then 'failed' else 'other' end",
)
_scalar("isin", lambda: F.col("COD_SES").isin("1", "2"), "COD_SES in ('1', '2')")
_scalar("null_test", lambda: ft.to_number(F.col("NOT_ELP")).isNull(), f"{num('NOT_ELP')} is null")
_scalar("between", lambda: ft.to_number(F.col("NOT_ELP")).between(0, 20), f"{num('NOT_ELP')} between 0 and 20")
_scalar(
    "bool_logic",
    lambda: (F.col("COD_TRE") == "V") & ~(ff.grade_value(F.col("NOT_ELP")) < 10) | F.col("COD_SES").isin("1"),
    f"(COD_TRE = 'V' and not ({grade('NOT_ELP')} < 10)) or COD_SES in ('1')",
)
_scalar("round_n", lambda: F.round(ft.to_number(F.col("NOT_ELP")) / 3, 2), f"round({num('NOT_ELP')} / 3, 2)")
_scalar("abs", lambda: F.abs(ft.to_number(F.col("NOT_ELP"))), f"abs({num('NOT_ELP')})")
_scalar("log2", lambda: F.log2(ft.to_number(F.col("COD_ETU"))), f"round(log2({num('COD_ETU')}), 6)")
_scalar("default_literal", lambda: F.lit("cleaned"), "'cleaned'")
_scalar(
    "default_if_missing",
    lambda: F.coalesce(ff.grade_value(F.col("NOT_ELP")), F.lit(0.0)),
    f"coalesce({grade('NOT_ELP')}, 0)",
)
_scalar(
    "format_pct",
    lambda: ft.percent_text(ft.to_number(F.col("NOT_ELP")), signed=True),
    f"case when {num('NOT_ELP')} is null then null else case when {num('NOT_ELP')} >= 0 then '+' else '' end "
    f"|| printf('%.2f%%', {num('NOT_ELP')}) end",
)

_of_parts("split", lambda: F.array_join("parts", "|"), "array_to_string(p, '|')")
_of_parts("array_size", lambda: F.size("parts"), "cast(n as int)")
_of_parts(
    "array_build",
    lambda: F.array_join(F.array(F.get("parts", F.lit(0)), F.lit("OK")), "|"),
    "array_to_string([p[1], 'OK'], '|')",
)
_of_parts("array_get", lambda: F.get("parts", F.lit(3)), "p[4]")
_of_parts(
    "array_concat",
    lambda: F.array_join(F.concat("parts", F.array(F.lit("OK"))), "|"),
    "array_to_string(list_append(p, 'OK'), '|')",
)

add(
    "quantile",
    lambda s, d: six(
        quantiles(fr.ingested(s, d).select(ft.to_number(F.col("NOT_ELP")).alias("x")), "x", [0.25, 0.75])
    ),
    sql(f"select round(quantile_cont({num('NOT_ELP')}, 0.25), 6) as q0, round(quantile_cont({num('NOT_ELP')}, 0.75), 6) as q1 from ingested"),
)


def _times(s, d):
    """Event times as ISO text, and that text read back as a naive time."""
    text = history.iso_text(F.col("ts"))
    return fr.table(s, d, "events").select(
        "event_id", text.alias("iso"), text.try_cast("timestamp_ntz").alias("parsed")
    )


add(
    "timestamp_io",
    _times,
    "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso, ts as parsed from events",
)
