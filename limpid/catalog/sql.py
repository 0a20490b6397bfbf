"""SQL for the checking engine: the derived lines and every frame, as common table expressions.

Written step by step from the rules, not from the Spark plans: cleaning here removes
copies twice and pair checks join twice, where the Spark side does each once.
"""

from __future__ import annotations

from limpid.catalog.frames import FIELD_EXPRESSIONS, HEADER, LINE_EXPRESSION, ORDER_EXPRESSIONS

RECORD = ("COD_ANU", "COD_ETU", "COD_ELP", "NOT_ELP", "COD_TRE", "COD_SES", "row_status")
SEVEN = (*RECORD[:6], "EXTRA")
FLAGS = (
    "elp_invalid_format", "note_missing_s1", "note_missing_s2", "note_out_of_range",
    "note_incoherent", "cod_tre_invalid", "cod_ses_missing", "cod_ses_invalid",
)
CLEANED = (*RECORD, *FLAGS)
CLEANED_TEXT = ("COD_ANU", "COD_ETU", "COD_ELP", "COD_TRE", "row_status")

CODES = "('V','AJ','RAT','VAR','ADM','NV','ACAR','ABSN')"
NOTEBOOK_CODES = "('V','RAT','VAR','ADM','NV','ACAR','ABS')"
TOKENS = (
    "['','#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN','-nan','1.#IND','1.#QNAN',"
    "'<NA>','N/A','NA','NULL','NaN','None','n/a','nan','null']"
)


def num(x: str) -> str:
    form = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
    return f"(case when regexp_matches({x}, '{form}') then try_cast(trim({x}) as double) end)"


def integer(x: str) -> str:
    t = f"trim({x})"
    return (
        rf"(case when regexp_matches({t}, '^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]*)$') then "
        rf"try_cast(regexp_extract({t}, '^([+-]?)([0-9]*)', 1)||'0'||regexp_extract({t}, '^([+-]?)([0-9]*)', 2) as int) end)"
    )


def year_form(x: str) -> str:
    return (
        rf"(case when {x} is null then 'NULL' when regexp_matches({x}, '^\d{{4}}-\d{{4}}$') then 'YYYY-YYYY' "
        rf"when regexp_matches({x}, '^\d{{2}}/\d{{2}}$') then 'YY/YY' "
        rf"when regexp_matches({x}, '^\d{{4}}$') then 'YYYY' else 'INVALID' end)"
    )


def year(x: str) -> str:
    return (
        f"(case {year_form(x)} when 'YYYY-YYYY' then {x} "
        f"when 'YYYY' then {x}||'-'||cast(try_cast({x} as int)+1 as varchar) "
        f"when 'YY/YY' then cast(2000+try_cast(substring({x},1,2) as int) as varchar)||'-'||"
        f"cast(2000+try_cast(substring({x},4,2) as int) as varchar) end)"
    )


def bad_course(x: str) -> str:
    return f"({x} is null or length({x}) <> 8 or not regexp_matches({x}, '^[a-zA-Z0-9]+$'))"


def grade(x: str) -> str:
    return (
        rf"(case when regexp_matches(trim({x}), '^[0-9]+([.,][0-9]+)?$') "
        rf"then try_cast(replace(trim({x}), ',', '.') as double) end)"
    )


def blank_d(x: str) -> str:
    return rf"({x} is null or regexp_matches({x}, '^\s*$|NULL|None'))"


def _field(i: int) -> str:
    fixed = f"p[{i}]" if i < 4 else ("p[4]||','||p[5]" if i == 4 else f"p[{i + 1}]")
    return f"case when n=6 then p[{i}] when n=7 then {fixed} end as {RECORD[i - 1]}"


def _slot(i: int) -> str:
    return f"case when not list_contains({TOKENS}, p[{i}]) then p[{i}] end as {SEVEN[i - 1]}"


_RANKED = "row_number() over (partition by COD_ETU, COD_SES, COD_ELP order by line_no) = 1"

BASE = f"""with
g0 as (select {", ".join(ORDER_EXPRESSIONS)}, unnest([0,1,2,3]) as s from orders),
g1 as (select *, k*4+s as ln from g0),
g2 as (select {", ".join(FIELD_EXPRESSIONS)} from g1),
lines as (
  select cast(ln as bigint) as line_no, batch, {LINE_EXPRESSION} from g2
  union all select cast(-1 as bigint), null, '{HEADER}'),
parts as (select line_no, batch, raw_line, string_split(raw_line, ',') as p,
  len(string_split(raw_line, ',')) as n from lines),
parsed as (select line_no, batch, {", ".join(_field(i) for i in range(1, 7))},
  case n when 6 then 'OK' when 7 then 'FIXED' else 'INVALID' end as row_status from parts),
ingested as (select * from parsed where COD_ANU <> 'COD_ANU'),
quarantined as (select * from parsed where COD_ANU is distinct from 'COD_ANU'),
all_but_first as (select * from parsed where line_no > (select min(line_no) from lines)),
ragged as materialized (select line_no, {", ".join(_slot(i) for i in range(1, 8))}, n > 7 as too_many_fields
  from parts where line_no > (select min(line_no) from lines) and regexp_matches(raw_line, '\\S')),
ragged_numeric as (select line_no, {num("COD_ANU")} as COD_ANU, {num("COD_ETU")} as COD_ETU, COD_ELP, NOT_ELP, COD_TRE,
  {num("COD_SES")} as COD_SES, EXTRA, {num("NOT_ELP")} as NOT_ELP_NUM from ragged),
c1 as (select line_no, batch, COD_ANU as year_read, {year("COD_ANU")} as COD_ANU, COD_ETU, COD_ELP, NOT_ELP, COD_TRE, COD_SES, row_status
  from ingested),
c2 as (select * from c1 qualify {_RANKED}),
c3 as (select * replace (case when {bad_course("upper(trim(COD_ELP))")} then null else upper(trim(COD_ELP)) end as COD_ELP),
  {bad_course("upper(trim(COD_ELP))")} as elp_invalid_format from c2),
c4 as (select * replace ({grade("NOT_ELP")} as NOT_ELP),
  {grade("NOT_ELP")} is null and {integer("COD_SES")} = 1 as note_missing_s1,
  {grade("NOT_ELP")} is null and {integer("COD_SES")} = 2 as note_missing_s2,
  {grade("NOT_ELP")} < 0 or {grade("NOT_ELP")} > 20 as note_out_of_range,
  (COD_TRE = 'V' and {grade("NOT_ELP")} < 10) or (COD_TRE = 'AJ' and {grade("NOT_ELP")} >= 10) as note_incoherent
  from c3),
c4d as (select * from c4 qualify {_RANKED}),
c5 as (select * replace (case when upper(trim(COD_TRE)) in {CODES} then upper(trim(COD_TRE)) end as COD_TRE,
  case when upper(trim(COD_TRE)) not in {CODES} then 'FLAGGED' else row_status end as row_status),
  COD_TRE is not null and upper(trim(COD_TRE)) not in {CODES} as cod_tre_invalid from c4d),
c6 as (select *, {integer("COD_SES")} as ses from c5),
cleaned as (select line_no, batch, COD_ANU, COD_ETU, COD_ELP, NOT_ELP, COD_TRE,
  case when ses in (1, 2) then ses end as COD_SES,
  case when ses is null or ses not in (1, 2) then 'FLAGGED' else row_status end as row_status,
  elp_invalid_format, note_missing_s1, note_missing_s2, note_out_of_range, note_incoherent, cod_tre_invalid,
  ses is null as cod_ses_missing, ses not in (1, 2) as cod_ses_invalid from c6)
"""


def sql(body: str) -> str:
    """``body`` over the frames; it may continue the WITH list by starting with a comma."""
    return BASE + body


def cols(names, prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


def lonely_pairs(frame: str, session: str) -> str:
    """Pairs with session 2 but not 1, by the two-set anti join; nulls match nulls."""
    return (
        f"select distinct a.COD_ETU, a.COD_ELP from (select * from {frame} where {session} = 2) a "
        f"where not exists (select 1 from {frame} b where b.{session} = 1 "
        "and b.COD_ETU is not distinct from a.COD_ETU and b.COD_ELP is not distinct from a.COD_ELP)"
    )


def with_number(frame: str, name: str, session_is_text: bool) -> str:
    x = num("COD_SES") if session_is_text else "cast(COD_SES as double)"
    return f", {name} as (select *, {x} as ses_number from {frame})"


def scores_d(frame: str, tag: str, text_session: bool, columns, text_columns, by: str | None = None) -> str:
    """CTEs ending in ``scores_<tag>``: the dashboard score row of ``frame`` (per ``by``)."""
    g = f"group by {by}" if by else ""
    b = f"{by}, " if by else ""
    k = by or "1"
    session = r"regexp_replace(cast(COD_SES as varchar), '\.0$', '')"
    share = lambda c: (
        f"(count(*) filter (where not {blank_d(c)}) / count(*) * 100)"
        if c in text_columns
        else f"(count({c}) / count(*) * 100)"
    )
    same = f"and x.{by} = y.{by}" if by else ""
    return (
        with_number(frame, f"{tag}_n", text_session)
        + f""",
{tag}_lonely as (select distinct {b}COD_ETU, COD_ELP from {tag}_n x where ses_number = 2 and not exists (
  select 1 from {tag}_n y where y.ses_number = 1 {same}
  and x.COD_ETU is not distinct from y.COD_ETU and x.COD_ELP is not distinct from y.COD_ELP)),
{tag}_bad as (select {k} as k, count(*) as bad from {tag}_n x where (COD_TRE is not null and NOT_ELP is null) or exists (
  select 1 from {tag}_lonely y where x.COD_ETU is not distinct from y.COD_ETU and x.COD_ELP is not distinct from y.COD_ELP {same})
  group by {k}),
{tag}_plain as (select {k} as k, count(*) as n, ({" + ".join(share(c) for c in columns)}) / {len(columns)} as complete,
  count(*) filter (where {session} in ('1','2') and (COD_TRE is null or COD_TRE in ('nan','None','NULL') or COD_TRE in {CODES}))
    / count(*) * 100 as valid,
  count(*) filter (where row_status is distinct from 'INVALID') / count(*) * 100 as schema_ok
  from {frame} group by {k}),
{tag}_keys as (select {k} as k, count(*) as keys from (select distinct {b}COD_ETU, COD_SES, COD_ELP from {frame}) group by {k}),
{tag}_ses as (select {k} as k, COD_SES, count(*) as n from {frame} where COD_SES is not null group by {k}, COD_SES),
{tag}_p as (select k, n / sum(n) over (partition by k) as p from {tag}_ses),
{tag}_ent as (select k, case count(*) when 1 then 100.0 else 100 * -sum(p * log2(p)) / log2(count(*)) end as ent from {tag}_p group by k),
scores_{tag} as (select {f"a.k as {by}," if by else ""}
  round(complete, 2) as "Complétude", round(100 * keys / n, 2) as "Unicité",
  round(100 * (1 - coalesce(bad, 0) / n), 2) as "Cohérence", round(valid, 2) as "Validité", round(valid, 2) as "Exactitude",
  round(coalesce(ent, 0), 2) as "Distribution", schema_ok
  from {tag}_plain a join {tag}_keys using (k) left join {tag}_bad using (k) left join {tag}_ent using (k))"""
    )


GLOBAL_D = (
    'round("Complétude"*0.2 + "Validité"*0.2 + "Exactitude"*0.15 + "Cohérence"*0.15 + "Unicité"*0.05 + "Distribution"*0.05, 2)'
)
DIMENSIONS = '"Complétude", "Unicité", "Cohérence", "Validité", "Exactitude", "Distribution"'

RAW_SCORES = scores_d("ingested", "raw", True, RECORD, RECORD)
CLEANED_SCORES = scores_d("cleaned", "done", False, CLEANED, CLEANED_TEXT)
HISTORY = (
    scores_d("ingested", "rb", True, RECORD, RECORD, "batch")
    + scores_d("cleaned", "cb", False, CLEANED, CLEANED_TEXT, "batch")
    + f""",
history as (
  select cast(batch||'-01 08:00:00' as timestamp) as "timestamp", 'raw' as stage, {DIMENSIONS}, {GLOBAL_D} as global_score from scores_rb
  union all
  select cast(batch||'-01 09:30:00.5' as timestamp), 'cleaned', {DIMENSIONS}, {GLOBAL_D} from scores_cb)
"""
)
