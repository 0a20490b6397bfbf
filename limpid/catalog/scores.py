"""Queries for quality scores, profiles, history and comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from limpid.catalog import frames as fr
from limpid.catalog.registry import add, six
from limpid.catalog.sql import (
    CLEANED,
    CLEANED_SCORES,
    CLEANED_TEXT,
    DIMENSIONS,
    GLOBAL_D,
    HISTORY,
    NOTEBOOK_CODES,
    RAW_SCORES,
    RECORD,
    SEVEN,
    blank_d,
    cols,
    lonely_pairs,
    num,
    sql,
    with_number,
)
from limpid.operators import keys, profile, quantiles
from limpid.functions.text import to_number
from limpid.plans import history, scoring
from limpid.rules import DEFAULT, Rules

NUMERIC_SEVEN = ("COD_ANU", "COD_ETU", "COD_ELP", "NOT_ELP", "COD_TRE", "COD_SES", "EXTRA", "NOT_ELP_NUM")
FIXED = Rules(compat=False)
KEY = DEFAULT.cols.key


def _first_dropped(s, d):
    """Parsed records without the first line, unparsable ones kept: what the notebook scores."""
    return fr.quarantined(s, d).drop("line_no")


def _one(frame, column):
    """A query with one aggregate column named score."""
    return lambda s, d: six(frame(s, d).agg(column().alias("score")))


def _row(frame, plan, *args):
    return lambda s, d: six(plan(frame(s, d), *args))


def _ingested(s, d):
    return fr.ingested(s, d).drop("line_no")


# --- counts and missing values ----------------------------------------------------------

add(
    "count_rows",
    lambda s, d: profile.count_rows(fr.ingested(s, d)),
    sql("select count(*) as rows from ingested"),
)


def _missing_sql(frame: str, columns, expression: str, tail: str = "") -> str:
    parts = " union all ".join(
        f"select '{c}' as column_name, {expression.format(c=c)} from {frame}" for c in columns
    )
    return sql(f"select * from ({parts}) {tail}")


add(
    "missing_total",
    lambda s, d: profile.missing_total(fr.ragged_seven(s, d)),
    sql("select cast(" + " + ".join(f"count(*) - count({c})" for c in SEVEN) + " as bigint) as missing_cells from ragged"),
)
add(
    "missing_rate_by_column",
    lambda s, d: six(profile.missing_rates(fr.ragged_seven(s, d), 3)),
    _missing_sql("ragged", SEVEN, "round(round_even((count(*) - count({c})) / count(*), 3) * 100, 6) as missing_pct"),
)
add(
    "missing_rate_rank",
    lambda s, d: six(profile.missing_rank(fr.cleaned_record(s, d))),
    _missing_sql(
        "cleaned", CLEANED, "round((count(*) - count({c})) / count(*) * 100, 6) as missing_pct",
        "where missing_pct > 0 order by missing_pct desc, column_name limit 40",
    ),
)
add(
    "filter_missing_cols",
    lambda s, d: six(profile.missing_rates(fr.cleaned_record(s, d)).where("missing_pct > 0")),
    _missing_sql(
        "cleaned", CLEANED, "round((count(*) - count({c})) / count(*) * 100, 6) as missing_pct", "where missing_pct > 0"
    ),
)

_PAIRS = [(a, b) for i, a in enumerate(CLEANED) for b in CLEANED[i + 1:]
          if not {a, b} & {"note_out_of_range", "note_incoherent"}]
_CORR = " union all ".join(
    f"select '{a}' as col_a, '{b}' as col_b, count(*) as n, count(*) - count({a}) as ca, count(*) - count({b}) as cb, "
    f"count(*) filter (where {a} is null and {b} is null) as ab from cleaned"
    for a, b in _PAIRS
)
add(
    "missing_correlation",
    lambda s, d: six(profile.missing_correlation(fr.cleaned_record(s, d))),
    sql(
        "select col_a, col_b, round(cast(n * ab - ca * cb as double) / "
        "nullif(sqrt(cast(n * ca - ca * ca as double)) * sqrt(cast(n * cb - cb * cb as double)), 0), 6) as corr "
        f"from ({_CORR}) where ca > 0 and cb > 0"
    ),
)


# --- exploration profile ----------------------------------------------------------------


def _pct_sql(frame: str, columns, share: str) -> str:
    """(column_name, pct, mean_pct) from a share expression per column."""
    wide = ", ".join(f"{share.format(c=c)} as {c}" for c in columns)
    mean = f"({' + '.join(columns)}) / {len(columns)}"
    rows = " union all ".join(f"select '{c}' as column_name, round({c}, 6) as pct, mean_pct from m" for c in columns)
    return f", w as (select {wide} from {frame}), m as (select *, round({mean}, 6) as mean_pct from w) {rows}"


def _distinct(frame: str) -> str:
    return f"(select count(*) from (select distinct {cols(KEY)} from {frame}))"


_E = {
    "accuracy": "round_even((count(*) filter (where COD_SES in (1, 2)) + count(*) filter (where NOT_ELP_NUM between 0 and 20))"
    " / (2 * count(*)) * 100, 2)",
    "consistency": "round_even((1 - count(*) filter (where COD_TRE = 'V' and NOT_ELP_NUM is null) / count(*)) * 100, 2)",
    "uniqueness": f"round_even({_distinct('ragged_numeric')} / count(*) * 100, 2)",
    "validity_format": "round_even((count(*) filter (where COD_ANU between 2000 and 2100) + count(COD_ETU)) / (2 * count(*)) * 100, 2)",
    "extreme_values": "round_even((1 - count(*) filter (where NOT_ELP_NUM < 0 or NOT_ELP_NUM > 20) / count(*)) * 100, 2)",
    "session_distribution": "round_even(count(*) filter (where COD_SES in (1, 2)) / count(*) * 100, 2)",
}


def _e_sql(name: str) -> str:
    return sql(f"select {_E[name]} as score from ragged_numeric")


add(
    "completeness_e",
    _row(fr.ragged_numeric, scoring.completeness_e),
    sql(_pct_sql("ragged_numeric", NUMERIC_SEVEN, "round_even(count({c}) / count(*) * 100, 2)")),
)
add("uniqueness_e", _row(fr.ragged_numeric, scoring.uniqueness_e), _e_sql("uniqueness"))
add("coherence_e", _one(fr.ragged_numeric, scoring.coherence_e), _e_sql("consistency"))
add("validity_e", _one(fr.ragged_numeric, scoring.validity_e), _e_sql("validity_format"))
add("accuracy_e", _one(fr.ragged_numeric, scoring.accuracy_e), _e_sql("accuracy"))
add("extreme_values_e", _one(fr.ragged_numeric, scoring.extreme_values_e), _e_sql("extreme_values"))
add("session_share_e", _one(fr.ragged_numeric, scoring.session_share_e), _e_sql("session_distribution"))
_COMPLETE_E = "(" + " + ".join(f"round_even(count({c}) / count(*) * 100, 2)" for c in NUMERIC_SEVEN) + ") / 8"
add(
    "global_score_e",
    _row(fr.ragged_numeric, scoring.scores_e),
    sql(
        f", e as (select {_COMPLETE_E} as completeness, "
        + ", ".join(f"{x} as {n}" for n, x in _E.items())
        + " from ragged_numeric) select * replace (round(completeness, 6) as completeness), "
        "round_even((completeness + accuracy + consistency + uniqueness + validity_format + extreme_values "
        "+ session_distribution) / 7, 2) as global_score from e"
    ),
)
add(
    "quality_issue_summary",
    lambda s, d: profile.issue_summary(fr.ragged(s, d)),
    sql(
        "select cast(" + " + ".join(f"count(*) - count({c})" for c in SEVEN) + " as bigint) as missing_cells, "
        "count(EXTRA) as extra_field_rows, "
        "count(*) filter (where COD_SES is null or COD_SES not in ('1', '2')) as invalid_sessions, "
        f"count(*) - (select count(*) from (select distinct {cols(SEVEN)} from ragged)) as duplicate_rows from ragged"
    ),
)
add(
    "duplicate_rows_full",
    lambda s, d: profile.duplicate_rows(fr.ragged_seven(s, d)),
    sql(f"select count(*) - (select count(*) from (select distinct {cols(SEVEN)} from ragged)) as duplicate_rows from ragged"),
)


# --- notebook profile -------------------------------------------------------------------

_N = {
    "completude": "(" + " + ".join(rf"count(*) filter (where regexp_matches({c}, '\S'))" for c in RECORD)
    + ") / (count(*) * 7)",
    "unicite": f"1 - (count(*) - {_distinct('quarantined')}) / count(*)",
    "coherence": "1 - count(*) filter (where COD_TRE is not null and NOT_ELP is null) / count(*)",
    "validite": f"count(*) filter (where COD_SES in ('1','2') and (COD_TRE in {NOTEBOOK_CODES} or COD_TRE is null)) / count(*)",
    "exactitude": f"count(*) filter (where {num('NOT_ELP')} between 0 and 20) / count(*)",
    "distribution": "case when count(*) >= 0 then 1.0::double end",
    "schema_integrity": "count(*) filter (where row_status is distinct from 'FIXED') / count(*)",
}


def _n_sql(name: str) -> str:
    return sql(f"select round({_N[name]}, 6) as score from quarantined")


add(
    "completeness_n",
    _one(_first_dropped, lambda: scoring.completeness_n(RECORD)),
    _n_sql("completude"),
)
add("uniqueness_n", _row(_first_dropped, scoring.uniqueness), _n_sql("unicite"))
add("coherence_n", _row(_first_dropped, scoring.coherence_n), _n_sql("coherence"))
_PAIR_BAD = (
    "(COD_TRE is not null and NOT_ELP is null) or exists (select 1 from lonely l where "
    "l.COD_ETU is not distinct from x.COD_ETU and l.COD_ELP is not distinct from x.COD_ELP)"
)
add(
    "coherence_n_fixed",
    _row(_first_dropped, scoring.coherence_n, FIXED),
    sql(
        with_number("quarantined", "numbered", True)
        + f", lonely as ({lonely_pairs('numbered', 'ses_number')}), bad as (select count(*) as bad from quarantined x where {_PAIR_BAD}) "
        "select round(1 - (select bad from bad) / count(*), 6) as score from quarantined"
    ),
)
add("validity_n", _one(_first_dropped, scoring.validity_n), _n_sql("validite"))
add("accuracy_n", _one(_first_dropped, scoring.accuracy_n), _n_sql("exactitude"))
add(
    "format_score_n",
    _one(_first_dropped, scoring.format_n),
    sql(
        r"select round(count(*) filter (where regexp_matches(COD_ANU, '^\d{4}$') and regexp_matches(COD_ELP, '^[A-Z0-9]+$')) "
        "/ count(*), 6) as score from quarantined"
    ),
)
add(
    "outlier_score_iqr",
    _row(_first_dropped, scoring.outlier_score_n),
    sql(
        f", v as (select {num('NOT_ELP')} as x from quarantined), "
        "q as (select quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.75) as q3 from v) "
        "select round(1 - count(*) filter (where x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1)) / count(x), 6) as score "
        "from v, q"
    ),
)
add(
    "session_balance_n",
    lambda s, d: six(
        _first_dropped(s, d).agg(
            scoring.session_balance_n().alias("score"), scoring.session_balance_n(FIXED).alias("score_fixed")
        )
    ),
    sql(
        "select 1.0::double as score, round(1 - abs(count(*) filter (where COD_SES = '1') / count(COD_SES) "
        "- count(*) filter (where COD_SES = '2') / count(COD_SES)), 6) as score_fixed from quarantined"
    ),
)
add("schema_integrity_n", _one(_first_dropped, scoring.schema_integrity_n), _n_sql("schema_integrity"))
_N_ROW = (
    ", n as (select " + ", ".join(f"{x} as {name}" for name, x in _N.items()) + " from quarantined), "
    "ng as (select *, completude*0.2 + validite*0.2 + exactitude*0.15 + coherence*0.15 + unicite*0.05 "
    "+ distribution*0.05 + schema_integrity*0.2 as global_score from n) "
)
add(
    "global_score_n",
    _row(_first_dropped, scoring.scores_n),
    sql(_N_ROW + "select " + ", ".join(f"round({c}, 6) as {c}" for c in [*_N, "global_score"]) + " from ng"),
)
_REPORT = (
    _N_ROW + ", report as (select metric, round(score, 6) as score, round_even(score * 100, 1) as score_pct from ("
    + " union all ".join(f"select '{c}' as metric, {c} as score from ng" for c in _N)
    + " union all select 'Score Global', global_score from ng)) "
)


def _report(s, d):
    return history.score_report(scoring.scores_n(_first_dropped(s, d)))


add("score_report", lambda s, d: six(_report(s, d)), sql(_REPORT + "select * from report"))
add(
    "report_sorted",
    lambda s, d: six(history.report_by_score(_report(s, d))),
    sql(_REPORT + "select * from report where metric <> 'Score Global' order by score_pct, metric"),
)


# --- dashboard profile ------------------------------------------------------------------


def _share_d(text: tuple[str, ...]):
    return lambda c: (
        f"count(*) filter (where not {blank_d(c)}) / count(*) * 100" if c in text else f"count({c}) / count(*) * 100"
    )


def _complete_d(frame: str, columns, text) -> str:
    share = _share_d(text)
    wide = ", ".join(f"{share(c)} as {c}" for c in columns)
    mean = f"({' + '.join(columns)}) / {len(columns)}"
    rows = " union all ".join(f"select '{c}' as column_name, round({c}, 6) as pct, mean_pct from m" for c in columns)
    return sql(f", w as (select {wide} from {frame}), m as (select *, round({mean}, 6) as mean_pct from w) {rows}")


_ALL_D = f"select {DIMENSIONS}, {GLOBAL_D} as global_score from "
_STAGES = {
    "raw": (_ingested, "ingested", RECORD, RECORD, RAW_SCORES, "scores_raw", "COD_SES"),
    "cleaned": (fr.cleaned_record, "cleaned", CLEANED, CLEANED_TEXT, CLEANED_SCORES, "scores_done", "COD_SES"),
}
_D_EXACT = {
    "uniqueness_d": "100 * {distinct} / count(*)",
    "validity_d": r"count(*) filter (where regexp_replace(cast(COD_SES as varchar), '\.0$', '') in ('1','2') and "
    "(COD_TRE is null or COD_TRE in ('nan','None','NULL') or "
    "COD_TRE in ('V','AJ','RAT','VAR','ADM','NV','ACAR','ABSN'))) / count(*) * 100",
    "schema_integrity_d": "count(*) filter (where row_status is distinct from 'INVALID') / count(*) * 100",
}
for _stage, (_frame, _name, _columns, _text, _ctes, _scores, _ses) in _STAGES.items():
    _tail = "" if _stage == "cleaned" else "_raw"
    add(
        f"completeness_d{_tail}",
        _row(_frame, scoring.completeness_d),
        _complete_d(_name, _columns, _text),
    )
    add(
        f"uniqueness_d{_tail}",
        lambda s, d, f=_frame: six(scoring.uniqueness(f(s, d)).select((100 * F.col("score")).alias("score"))),
        sql(f"select round(100 * {_distinct(_name)} / count(*), 6) as score from {_name}"),
    )
    _number = with_number(_name, "numbered", _stage == "raw")
    add(
        f"coherence_d{_tail}",
        _row(_frame, scoring.coherence_d),
        sql(
            _number + f", lonely as ({lonely_pairs('numbered', 'ses_number')}), "
            f"bad as (select count(*) as bad from {_name} x where {_PAIR_BAD}) "
            f"select round(100 * (1 - (select bad from bad) / count(*)), 6) as score from {_name}"
        ),
    )
    for _key, _agg in (("validity_d", scoring.validity_d), ("schema_integrity_d", scoring.schema_integrity_d)):
        add(
            f"{_key}{_tail}",
            lambda s, d, f=_frame, a=_agg: six((lambda df: df.agg(a(df).alias("score")))(f(s, d))),
            sql(f"select round({_D_EXACT[_key]}, 6) as score from {_name}"),
        )
    add(
        f"distribution_entropy_d{_tail}",
        _row(_frame, scoring.distribution_d),
        sql(
            f", c as (select count(*) as n from {_name} where COD_SES is not null group by COD_SES), "
            "p as (select n / sum(n) over () as p from c) "
            "select round(100 * -sum(p * log2(p)) / log2(count(*)), 6) as score from p"
        ),
    )
    add(
        f"global_score_d{_tail}",
        _row(_frame, scoring.scores_d),
        sql(_ctes + " " + _ALL_D + _scores),
    )
add(
    "accuracy_d",
    lambda s, d: six((lambda df: df.agg(scoring.validity_d(df).alias("Exactitude")))(fr.cleaned_record(s, d))),
    sql(f"select round({_D_EXACT['validity_d']}, 6) as \"Exactitude\" from cleaned"),
)
add(
    "global_score_seven",
    lambda s, d: six(scoring.scores_d(fr.cleaned_record(s, d), with_schema=True)),
    sql(
        CLEANED_SCORES
        + f', seven as (select {DIMENSIONS}, round(schema_ok, 2) as "Intégrité Schéma" from scores_done) '
        'select *, round("Complétude"*0.2 + "Validité"*0.2 + "Exactitude"*0.15 + "Cohérence"*0.15 + "Unicité"*0.05 '
        '+ "Distribution"*0.05 + "Intégrité Schéma"*0.2, 2) as global_score from seven'
    ),
)
add(
    "distribution_entropy_events",
    lambda s, d: six(scoring.distribution_d(fr.table(s, d, "events"), "event_type")),
    "with c as (select count(*) as n from events group by event_type), p as (select n / sum(n) over () as p from c) "
    "select round(100 * -sum(p * log2(p)) / log2(count(*)), 6) as score from p",
)


# --- value counts and column profiles ---------------------------------------------------

_TYPES = {"NOT_ELP": "double", "COD_SES": "int", **{c: "boolean" for c in CLEANED[7:]}}


def _values(frame, column):
    return lambda s, d: six(profile.value_counts(frame(s, d), column))


add(
    "value_counts_all",
    _values(fr.ragged, "COD_SES"),
    sql(
        "select COD_SES as value, count(*) as count, round(count(*) / (select count(COD_SES) from ragged), 6) as share "
        "from ragged where COD_SES is not null group by COD_SES"
    ),
)
add(
    "value_counts_event_type",
    _values(lambda s, d: fr.table(s, d, "events"), "event_type"),
    "select event_type as value, count(*) as count, round(count(*) / (select count(event_type) from events), 6) as share "
    "from events where event_type is not null group by event_type",
)


def _profile_sql(frame: str, columns, types, prefix: str) -> str:
    rows = " union all ".join(
        f"select '{c}' as column_name, '{types.get(c, 'string')}' as data_type, count(distinct {c}) as distinct_count, "
        f"count(*) - count({c}) as missing, round(100.0 * (count(*) - count({c})) / count(*), 6) as missing_pct, "
        f"(select cast({c} as varchar) from {frame} where {c} is not null group by {c} order by count(*) desc, {c} limit 1) as top_value, "
        f"(select count(*) from {frame} where {c} is not null group by {c} order by count(*) desc limit 1) as top_count from {frame}"
        for c in columns
    )
    return prefix + rows


add(
    "column_profile",
    lambda s, d: six(profile.column_profile(fr.cleaned_record(s, d))),
    _profile_sql("cleaned", CLEANED, _TYPES, sql("")),
)
add(
    "column_profile_orders",
    lambda s, d: six(
        profile.column_profile(fr.table(s, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    ),
    _profile_sql(
        "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
        {"o_orderkey": "bigint", "o_custkey": "bigint"}, "",
    ),
)
add(
    "top20_values",
    lambda s, d: profile.shown_values(fr.cleaned(s, d), "COD_ELP", 20),
    sql(
        "select COD_ELP as value, count(*) as count from cleaned where COD_ELP is not null group by COD_ELP "
        "order by count desc, value limit 20"
    ),
)
add(
    "top20_values_numeric",
    lambda s, d: profile.shown_values(fr.cleaned(s, d), "COD_SES", 20),
    sql(
        "select COD_SES as value, count(*) as count from cleaned where COD_SES is not null "
        "and (select count(distinct COD_SES) from cleaned) < 50 group by COD_SES order by count desc, value limit 20"
    ),
)


def _describe_sql(x: str, frame: str) -> str:
    return (
        f"select count({x}) as count, round(avg({x}), 6) as mean, round(stddev_samp({x}), 6) as std, round(min({x}), 6) as min, "
        f"round(quantile_cont({x}, 0.25), 6) as p25, round(quantile_cont({x}, 0.5), 6) as p50, "
        f"round(quantile_cont({x}, 0.75), 6) as p75, round(max({x}), 6) as max from {frame}"
    )


add(
    "describe_numeric",
    lambda s, d: six(profile.describe_numeric(fr.cleaned(s, d), "NOT_ELP")),
    sql(_describe_sql("NOT_ELP", "cleaned")),
)
add(
    "describe_totalprice",
    lambda s, d: six(profile.describe_numeric(fr.table(s, d, "orders"), "o_totalprice")),
    _describe_sql("o_totalprice", "orders"),
)


def _describe_all_sql(frame: str, text, numeric) -> str:
    top = "(select {f} from {frame} where {c} is not null group by {c} order by count(*) desc, cast({c} as varchar) limit 1)"
    none = ", ".join(f"cast(null as double) as {n}" for n in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    rows = [
        f"select '{c}' as column_name, count({c}) as count, count(distinct {c}) as \"unique\", "
        + top.format(f=f"cast({c} as varchar)", frame=frame, c=c) + " as top, "
        + top.format(f="count(*)", frame=frame, c=c) + f" as freq, {none} from {frame}"
        for c in text
    ]
    for c in numeric:
        inner = _describe_sql(f"cast({c} as double)", frame)
        rows.append(
            f"select '{c}', count, cast(null as bigint), cast(null as varchar), cast(null as bigint), "
            f"mean, std, min, p25, p50, p75, max from ({inner})"
        )
    return sql(" union all ".join(rows))


add(
    "describe_all",
    lambda s, d: six(profile.describe_all(fr.ragged_seven(s, d))),
    _describe_all_sql("ragged", SEVEN, ()),
)
add(
    "describe_all_cleaned",
    lambda s, d: six(profile.describe_all(fr.cleaned_record(s, d))),
    _describe_all_sql("cleaned", [c for c in CLEANED if c not in ("NOT_ELP", "COD_SES")], ("NOT_ELP", "COD_SES")),
)
add(
    "table_info",
    lambda s, d: profile.table_info(fr.cleaned_record(s, d)),
    sql(
        " union all ".join(
            f"select '{c}' as column_name, '{_TYPES.get(c, 'string')}' as data_type, count({c}) as non_null from cleaned"
            for c in CLEANED
        )
    ),
)


def _histogram_sql(value: str, frame: str, prefix: str) -> str:
    lead = "," if prefix else "with"
    return (
        prefix + f"{lead} v as (select {value} as x from {frame}), e as (select min(x) as lo, max(x) as hi, (max(x) - min(x)) / 20 as w from v), "
        "g as (select x, lo, w, least(cast(floor((x - lo) / (hi - lo) * 20) as bigint), 19) as g from v, e where x is not null), "
        "b as (select g + case when x < lo + g * w then -1 when x >= lo + (g + 1) * w and g < 19 then 1 else 0 end as bin, "
        "count(*) as n from g group by 1) "
        "select i as bin, round(lo + i * w, 6) as low, round(case when i = 19 then hi else lo + (i + 1) * w end, 6) as high, "
        "coalesce(n, 0) as count from (select unnest(range(20)) as i), e left join b on b.bin = i"
    )


add(
    "grade_histogram",
    lambda s, d: six(quantiles.histogram(fr.ragged(s, d).select(to_number(F.col("NOT_ELP")).alias("x")), "x")),
    _histogram_sql(num("NOT_ELP"), "ragged", sql("")),
)
add(
    "histogram_totalprice",
    lambda s, d: six(quantiles.histogram(fr.table(s, d, "orders"), "o_totalprice")),
    _histogram_sql("o_totalprice", "orders", ""),
)
_DECILES = [i / 10 for i in range(11)]
add(
    "deciles_extendedprice",
    lambda s, d: six(quantiles.quantiles(fr.table(s, d, "lineitem"), "l_extendedprice", _DECILES)),
    "select " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) as q{i}" for i, p in enumerate(_DECILES)) + " from lineitem",
)
add(
    "duplicate_rows_documents",
    lambda s, d: profile.duplicate_texts(fr.table(s, d, "documents"), "text"),
    "select count(*) - count(distinct text) as duplicate_rows from documents",
)
add(
    "uniqueness_lineitem",
    lambda s, d: six(
        keys.count_copies(fr.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
            (F.col("distinct_keys") / F.col("rows")).alias("score")
        )
    ),
    "select round((select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) / count(*), 6) as score from lineitem",
)


# --- history and comparison -------------------------------------------------------------

_H = "select * from history "
_METRIC_ORDER = ("Complétude", "Unicité", "Cohérence", "Validité", "Exactitude", "Distribution", "global_score")
_LATEST = "select * from history qualify row_number() over (partition by stage order by timestamp desc) = 1"
_MELT = (
    f", latest as ({_LATEST}), long as ("
    + " union all ".join(
        f"select timestamp, stage, '{m}' as metric, \"{m}\" as score, {i} as place from latest"
        for i, m in enumerate(_METRIC_ORDER, 1)
    )
    + ") "
)
add("history_sorted", lambda s, d: history.by_time(fr.history(s, d)), sql(HISTORY + _H + "order by timestamp"))
add("history_scores", lambda s, d: fr.derive_history(s, d), sql(HISTORY + _H))
add(
    "filter_stage",
    lambda s, d: history.of_stage(fr.history(s, d), "raw"),
    sql(HISTORY + _H + "where stage = 'raw'"),
)
add("latest_per_stage", lambda s, d: history.latest_per_stage(fr.history(s, d)), sql(HISTORY + _LATEST))
add("union_latest", lambda s, d: history.latest_pair(fr.history(s, d)), sql(HISTORY + _LATEST))


def _extended(s, d):
    rows = fr.history(s, d)
    old = history.of_stage(rows, "cleaned").drop("stage")
    new = history.of_stage(rows, "raw").withColumn("Intégrité Schéma", F.lit(100.0))
    return history.extend(old, new)


add(
    "union_by_name_evolving",
    _extended,
    sql(HISTORY + 'select *, case when stage = \'raw\' then 100.0::double end as "Intégrité Schéma" from history'),
)
add(
    "melt_scores",
    lambda s, d: history.melt_scores(history.latest_pair(fr.history(s, d))),
    sql(HISTORY + _MELT + "select * exclude (place) from long"),
)
add(
    "metric_display_order",
    lambda s, d: history.in_display_order(history.melt_scores(history.latest_pair(fr.history(s, d)))),
    sql(HISTORY + _MELT + "select * replace (cast(place as bigint) as place) from long order by place, timestamp, stage"),
)


def _raw_scores(s, d):
    return scoring.scores_d(_ingested(s, d))


def _cleaned_scores(s, d):
    return scoring.scores_d(fr.cleaned_record(s, d))


_COMPARE = (
    RAW_SCORES + CLEANED_SCORES + ", cmp as ("
    + " union all ".join(
        f"select '{m}' as dimension, r.\"{m}\" as before, c.\"{m}\" as after from scores_raw r, scores_done c"
        for m in _METRIC_ORDER[:6]
    )
    + ") "
)
add(
    "compare_before_after",
    lambda s, d: six(history.compare(_raw_scores(s, d), _cleaned_scores(s, d))),
    sql(_COMPARE + "select dimension, before, after, round(after - before, 6) as gain from cmp"),
)
_PCT = "printf('%.2f%%', {x})"
add(
    "compare_as_text",
    lambda s, d: history.compare(_raw_scores(s, d), _cleaned_scores(s, d), shown=True),
    sql(
        _COMPARE + f"select dimension, {_PCT.format(x='before')} as before, {_PCT.format(x='after')} as after, "
        f"case when after - before >= 0 then '+' else '' end || {_PCT.format(x='after - before')} as gain from cmp"
    ),
)
add(
    "kpi_delta",
    lambda s, d: six(
        history.kpi_delta(scoring.scores_d(_ingested(s, d), with_rows=True), scoring.scores_d(fr.cleaned_record(s, d), with_rows=True))
    ),
    sql(
        RAW_SCORES + CLEANED_SCORES
        + f", r as (select {GLOBAL_D} as g, \"Distribution\" as d from scores_raw), "
        f"c as (select {GLOBAL_D} as g, \"Distribution\" as d from scores_done) "
        "select (select count(*) from cleaned) as rows, (select count(*) from cleaned) - (select count(*) from ingested) as rows_delta, "
        "c.g as global_score, round(c.g - r.g, 6) as global_delta, c.d as distribution, round(c.d - r.d, 6) as distribution_delta from r, c"
    ),
)


# --- rows that plain tables don't have ----------------------------------------------------

_ODD_PRICE = "o_orderkey, case when o_orderkey % 50 = 0 then double('inf') when o_orderkey % 50 = 1 then double('-inf') when o_orderkey % 7 = 3 then double('nan') else o_totalprice end as price"


def _odd_prices(spark, sf_dir):
    """Order prices with infinite and undefined ones among them."""
    return fr.table(spark, sf_dir, "orders").selectExpr(*[e.strip() for e in _ODD_PRICE.split(", ", 1)])


_ODD_SQL = (
    "with odd as (select o_orderkey, case when o_orderkey % 50 = 0 then 'inf'::double when o_orderkey % 50 = 1 then '-inf'::double "
    "when o_orderkey % 7 = 3 then null else o_totalprice end as price from orders) "
)
add(
    "quantiles_infinite",
    lambda s, d: six(quantiles.quantiles(_odd_prices(s, d), "price", [0, 0.25, 0.5, 0.75, 1])),
    _ODD_SQL + "select min(price) as q0, round(quantile_cont(price, 0.25), 6) as q1, round(quantile_cont(price, 0.5), 6) as q2, "
    "round(quantile_cont(price, 0.75), 6) as q3, max(price) as q4 from odd",
)
add(
    "missing_counts_nan",
    lambda s, d: profile.missing_counts(_odd_prices(s, d)),
    _ODD_SQL + "select 'o_orderkey' as column_name, count(*) as rows, count(*) - count(o_orderkey) as missing from odd "
    "union all select 'price', count(*), count(*) - count(price) from odd",
)
add(
    "histogram_infinite",
    lambda s, d: quantiles.histogram(_odd_prices(s, d), "price", 10).where("bin in (-1, 10)").select("bin", "count"),
    _ODD_SQL + "select cast(-1 as bigint) as bin, count(*) as count from odd where price = '-inf'::double "
    "union all select cast(10 as bigint), count(*) from odd where price = 'inf'::double",
)


# --- whole tables with many columns, long texts and odd names -----------------------------

_LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
add(
    "describe_all_lineitem",
    lambda s, d: six(profile.describe_all(fr.table(s, d, "lineitem").select(*_LINE_NUMBERS))),
    " union all ".join(
        _describe_sql(f"cast({c} as double)", "lineitem").replace("select ", f"select '{c}' as column_name, null::bigint as unique, null::varchar as top, null::bigint as freq, ", 1)
        for c in _LINE_NUMBERS
    ),
)
add(
    "column_profile_documents",
    lambda s, d: six(profile.column_profile(fr.table(s, d, "documents"), ["text", "lang", "source"])),
    _profile_sql("documents", ["text", "lang", "source"], {}, ""),
)
add(
    "top_values_extendedprice",
    lambda s, d: profile.top_values(fr.table(s, d, "lineitem"), "l_extendedprice", 500),
    "select l_extendedprice as value, count(*) as count from lineitem group by l_extendedprice order by count desc, value limit 500",
)


def _odd_names(s, d):
    return _odd_prices(s, d).select(F.col("o_orderkey").alias("order.key"), F.col("price").alias("mean_pct"))


def _odd_completeness(digits: int | None) -> str:
    share = "100.0 * count(price) / count(*)"
    pct = share if digits is None else f"round({share}, {digits})"
    return (
        _ODD_SQL + f", s as (select {pct} as p from odd) select 'order.key' as column_name, 100.0::double as pct, round((100 + p) / 2, 6) as mean_pct from s "
        "union all select 'mean_pct', round(p, 6), round((100 + p) / 2, 6) from s"
    )


add("completeness_d_odd_columns", lambda s, d: six(scoring.completeness_d(_odd_names(s, d))), _odd_completeness(None))
add("completeness_e_odd_columns", lambda s, d: six(scoring.completeness_e(_odd_names(s, d))), _odd_completeness(2))
