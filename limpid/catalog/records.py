"""Queries that read, parse, clean and de-duplicate records."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from limpid.catalog import frames as fr
from limpid.catalog.registry import add, six
from limpid.catalog.sql import (
    CLEANED,
    FLAGS,
    HISTORY,
    RECORD,
    SEVEN,
    bad_course,
    cols,
    grade,
    integer,
    lonely_pairs,
    num,
    sql,
    with_number,
    year,
    year_form,
)
from limpid.functions import fields as ff
from limpid.functions.text import to_int, to_number
from limpid.operators import cleaners as cl
from limpid.operators import drill, keys, pairs, parsing
from limpid.operators.profile import sample_rows
from limpid.plans import cleaning, history
from limpid.rules import DASHBOARD_ORDER, DEFAULT
from limpid.sources import read, write
from limpid.sources.shared import new_folder, write_bytes

KEY = DEFAULT.cols.key
ALL = cols(("line_no", *RECORD))


# --- sources ----------------------------------------------------------------------------


def _text_folder(s, d):
    return fr.written(s, d, "text_lines", lambda p: fr.lines(s, d).select("raw_line").write.text(p))


def _broken_text_folder(s, d):
    # A byte that is no UTF-8 in the middle of every line.
    raw = F.expr("replace(raw_line, ',', concat(cast(X'FF' as string), ','))")
    return fr.written(s, d, "broken_lines", lambda p: fr.lines(s, d).select(raw).write.text(p))


def _ingested_folder(s, d):
    return fr.written(
        s, d, "legacy_ingested", lambda p: write.write_parquet(fr.ingested(s, d).drop("line_no"), p, legacy=True)
    )


def _cleaned_csv_folder(s, d):
    return fr.written(s, d, "cleaned_csv", lambda p: write.write_csv(fr.cleaned_record(s, d), p))


def _csv_tree(s, d):
    def put(path):
        rows = fr.cleaned_record(s, d)
        write.write_csv(rows.where("COD_SES is null"), f"{path}/a/none")
        write.write_csv(rows.where("COD_SES is not null"), f"{path}/b")

    return fr.written(s, d, "csv_tree", put)


def _parts_with_a_broken_one(s, d):
    def put(path):
        write.write_parquet(fr.ingested(s, d).drop("line_no"), path)
        write_bytes(s, f"{path}/part-99999-broken.parquet", b"this is no parquet file")

    return fr.written(s, d, "broken_parts", put)


def _history_csv(s, d):
    def put(path):
        rows = fr.history(s, d)
        write.write_csv(rows.withColumn("timestamp", history.iso_text(F.col("timestamp"))), path)

    return fr.written(s, d, "history_csv", put)


def _scan_or_empty(s, d):
    schema = read.ingested_schema()
    there = read.read_or_empty(s, _ingested_folder(s, d), schema)
    return there.union(read.read_or_empty(s, new_folder(s, "absent"), schema))


add(
    "scan_raw_text",
    lambda s, d: read.read_lines(s, _text_folder(s, d)).select("raw_line"),
    sql("select raw_line from lines"),
)
add(
    "scan_raw_text_lenient",
    lambda s, d: read.read_lines_lenient(s, _broken_text_folder(s, d)).select("raw_line"),
    sql("select raw_line from lines"),
)
add(
    "scan_ingested_parquet",
    lambda s, d: read.read_ingested(s, _ingested_folder(s, d)),
    sql(f"select {cols(RECORD)} from ingested"),
)
add(
    "scan_cleaned_csv",
    lambda s, d: read.read_cleaned_text(s, _cleaned_csv_folder(s, d)),
    sql("select " + ", ".join(f"nullif(cast({c} as varchar), '') as {c}" for c in CLEANED) + " from cleaned"),
)
add(
    "scan_ragged_csv",
    lambda s, d: read.read_ragged(s, _text_folder(s, d)).drop("surplus"),
    sql(f"select {cols(SEVEN)}, too_many_fields from ragged"),
)
add(
    "scan_csv_files_union",
    lambda s, d: read.read_csv_files(s, _csv_tree(s, d), read.cleaned_schema()),
    sql("select * replace (nullif(COD_ETU, '') as COD_ETU) from (select " + cols(CLEANED) + " from cleaned)"),
)
add(
    "scan_parquet_skip_corrupt",
    lambda s, d: read.read_parts(s, _parts_with_a_broken_one(s, d), read.ingested_schema()),
    sql(f"select {cols(RECORD)} from ingested"),
)
add(
    "scan_history",
    lambda s, d: read.read_history_csv(s, _history_csv(s, d), DASHBOARD_ORDER),
    sql(HISTORY + "select * from history"),
)
add("scan_or_empty", _scan_or_empty, sql(f"select {cols(RECORD)} from ingested"))


# --- sinks ------------------------------------------------------------------------------


def _sink_parquet(s, d):
    path = new_folder(s, "out")
    write.write_parquet(fr.ingested(s, d), path)
    return s.read.parquet(path)


def _sink_csv(s, d):
    path = new_folder(s, "out")
    write.write_csv(fr.ingested(s, d), path)
    return read.read_cleaned_text(s, path)


def _sink_row_count(s, d):
    rows = write.write_parquet(fr.ingested(s, d), new_folder(s, "out"))
    return s.createDataFrame([(rows,)], "rows_written long")


def _sink_history(s, d):
    """A history from before stages existed, then rows with a stage added to it."""
    path = new_folder(s, "history")
    rows = fr.history(s, d)
    write.append_history(history.of_stage(rows, "raw").drop("stage"), path)
    for _ in range(2):  # the second time, as after a failure, nothing is added
        write.append_history(history.of_stage(rows, "cleaned"), path, "cleaned-1")
    return read.read_history(s, path).drop("batch_id")


add("sink_parquet", _sink_parquet, sql(f"select {ALL} from ingested"))
add(
    "sink_csv",
    _sink_csv,
    sql(
        "select cast(line_no as varchar) as line_no, "
        # The writer strips blanks around a value, as it does by default.
        + ", ".join(f"nullif(trim({c}), '') as {c}" for c in RECORD)
        + " from ingested"
    ),
)
add("sink_history_append", _sink_history, sql(HISTORY + "select * replace ('cleaned' as stage) from history"))
add("sink_row_count", _sink_row_count, sql("select count(*) as rows_written from ingested"))
add(
    "preview_n",
    lambda s, d: write.preview(fr.ingested(s, d), "line_no", 30),
    sql(f"select {ALL} from ingested order by line_no limit 30"),
)


# --- parsing and projections ------------------------------------------------------------


def _plain_lines(s, d):
    return fr.lines(s, d).drop("batch")


def _split(s, d):
    return parsing.split_lines(_plain_lines(s, d))


add(
    "split_line",
    lambda s, d: _split(s, d).select(
        "line_no", F.size("parts").alias("n_fields"), F.array_join("parts", "|").alias("joined")
    ),
    sql("select line_no, cast(n as int) as n_fields, array_to_string(p, '|') as joined from parts"),
)
add(
    "classify_row",
    lambda s, d: _split(s, d).select("line_no", parsing.row_status(F.col("parts")).alias("row_status")),
    sql("select line_no, row_status from parsed"),
)


def _repair(s, d):
    parts = F.col("parts")
    status = parsing.row_status(parts)
    fixed = [parsing.repaired_field(parts, status, i).alias(f"f{i}") for i in range(6)]
    return _split(s, d).where(status == "FIXED").select("line_no", *fixed)


add(
    "repair_embedded_comma",
    _repair,
    sql(
        "select line_no, p[1] as f0, p[2] as f1, p[3] as f2, p[4]||','||p[5] as f3, p[6] as f4, p[7] as f5 "
        "from parts where n = 7"
    ),
)
add(
    "null_out_invalid",
    lambda s, d: parsing.records_from_parts(_split(s, d)).where("row_status = 'INVALID'"),
    sql("select line_no, " + ", ".join(f"cast(null as varchar) as {c}" for c in RECORD[:6])
        + ", 'INVALID' as row_status from parts where n not in (6, 7)"),
)
add(
    "project_positional",
    lambda s, d: parsing.records_from_parts(_split(s, d)),
    sql(f"select {ALL} from parsed"),
)
add(
    "drop_header_by_value",
    lambda s, d: parsing.drop_header_by_value(parsing.records_from_parts(_split(s, d))),
    sql(f"select {ALL} from parsed where COD_ANU <> 'COD_ANU'"),
)
add(
    "drop_header_keep_invalid",
    lambda s, d: parsing.parse_lines(_plain_lines(s, d), keep_invalid=True),
    sql(f"select {ALL} from quarantined"),
)
add("parse_lines", lambda s, d: parsing.parse_lines(_plain_lines(s, d)), sql(f"select {ALL} from ingested"))
add(
    "drop_header_by_position",
    lambda s, d: parsing.records_from_parts(parsing.split_lines(parsing.drop_first_row(_plain_lines(s, d)))),
    sql(f"select {ALL} from all_but_first"),
)
add(
    "business_projection",
    lambda s, d: cl.business_projection(fr.cleaned(s, d)),
    sql(f"select {cols(RECORD)} from cleaned"),
)
add(
    "drop_helpers",
    lambda s, d: keys.with_row_number(fr.ingested(s, d), KEY, "line_no").where("row_number = 1").drop("row_number"),
    sql(f"select {ALL} from ingested qualify row_number() over (partition by {cols(KEY)} order by line_no) = 1"),
)
add(
    "ensure_row_status",
    lambda s, d: cl.ensure_row_status(fr.ingested(s, d).drop("row_status")),
    sql(f"select {cols(('line_no', *RECORD[:6]))}, 'OK' as row_status from ingested"),
)
add(
    "ragged_records",
    lambda s, d: parsing.ragged_records(parsing.drop_first_row(_plain_lines(s, d))).drop("surplus"),
    sql("select * from ragged"),
)
add(
    "coerce_numeric",
    lambda s, d: parsing.coerce_numeric(fr.ragged(s, d).drop("too_many_fields")),
    sql("select * from ragged_numeric"),
)

_FLAGGED_ROWS = f""",
flagged as (select line_no, {year("COD_ANU")} as COD_ANU, COD_ETU,
  case when not {bad_course("upper(trim(COD_ELP))")} then upper(trim(COD_ELP)) end as COD_ELP,
  {grade("NOT_ELP")} as NOT_ELP,
  case when upper(trim(COD_TRE)) in ('V','AJ','RAT','VAR','ADM','NV','ACAR','ABSN') then upper(trim(COD_TRE)) end as COD_TRE,
  case when {integer("COD_SES")} in (1, 2) then {integer("COD_SES")} end as COD_SES,
  case when coalesce({integer("COD_SES")} not in (1, 2), true)
    or upper(trim(COD_TRE)) not in ('V','AJ','RAT','VAR','ADM','NV','ACAR','ABSN') then 'FLAGGED' else row_status end as row_status,
  {bad_course("upper(trim(COD_ELP))")} as elp_invalid_format,
  {grade("NOT_ELP")} is null and {integer("COD_SES")} = 1 as note_missing_s1,
  {grade("NOT_ELP")} is null and {integer("COD_SES")} = 2 as note_missing_s2,
  {grade("NOT_ELP")} < 0 or {grade("NOT_ELP")} > 20 as note_out_of_range,
  (COD_TRE = 'V' and {grade("NOT_ELP")} < 10) or (COD_TRE = 'AJ' and {grade("NOT_ELP")} >= 10) as note_incoherent,
  coalesce(upper(trim(COD_TRE)) not in ('V','AJ','RAT','VAR','ADM','NV','ACAR','ABSN'), false) as cod_tre_invalid,
  {integer("COD_SES")} is null as cod_ses_missing, {integer("COD_SES")} not in (1, 2) as cod_ses_invalid from ingested)
"""
add(
    "error_flag_projection",
    lambda s, d: cleaning.error_flags(fr.ingested(s, d), carry=("line_no",)),
    sql(_FLAGGED_ROWS + f"select {cols(('line_no', *CLEANED))} from flagged"),
)


# --- filters ----------------------------------------------------------------------------

add(
    "filter_invalid_sessions",
    lambda s, d: drill.invalid_sessions(fr.ragged(s, d)),
    sql("select * from ragged where COD_SES is null or COD_SES not in ('1', '2')"),
)
add(
    "filter_structural_anomalies",
    lambda s, d: drill.structural_anomalies(fr.ragged(s, d)),
    sql("select * from ragged where EXTRA is not null"),
)
add(
    "drill_invalid_rows",
    lambda s, d: drill.invalid_rows(fr.quarantined(s, d)),
    sql(f"select {ALL} from quarantined where row_status = 'INVALID'"),
)
_ANY_NULL = " or ".join(f"{c} is null" for c in CLEANED)
add(
    "drill_missing_rows",
    lambda s, d: six(drill.first_incomplete_rows(fr.cleaned(s, d), "line_no", 100)),
    sql(
        f"select {cols(('line_no', *CLEANED))}, (select count(*) from cleaned where {_ANY_NULL}) as incomplete_rows "
        f"from cleaned where {_ANY_NULL} order by line_no limit 100"
    ),
)
add(
    "drill_duplicate_rows",
    lambda s, d: drill.duplicate_members(fr.ingested(s, d), ("COD_ETU", "COD_ELP", "COD_SES"), "line_no"),
    sql(f"select {ALL} from ingested qualify count(*) over (partition by {cols(KEY)}) > 1"),
)
add(
    "drill_duplicate_rows_cleaned",
    lambda s, d: drill.duplicate_members(fr.cleaned(s, d), ("COD_ETU", "COD_ELP", "COD_SES"), "line_no"),
    sql(f"select {cols(('line_no', *CLEANED))} from cleaned qualify count(*) over (partition by {cols(KEY)}) > 1"),
)
add(
    "keep_first_row",
    lambda s, d: keys.keep_first(fr.ingested(s, d), KEY, "line_no"),
    sql(f"select {ALL} from ingested qualify row_number() over (partition by {cols(KEY)} order by line_no) = 1"),
)

_COUNTS = {
    "year_null": f"{year('COD_ANU')} is null",
    "year_off_form": rf"not regexp_matches({year('COD_ANU')}, '^\d{{4}}-\d{{4}}$')",
    "year_corrected": f"{year_form('COD_ANU')} <> 'YYYY-YYYY'",
    "student_null": "COD_ETU is null",
    "course_invalid": bad_course("upper(trim(COD_ELP))"),
    "status_invalid": "upper(trim(COD_TRE)) not in ('V','AJ','RAT','VAR','ADM','NV','ACAR','ABSN')",
    "session_missing": f"{integer('COD_SES')} is null",
    "session_invalid": f"{integer('COD_SES')} not in (1, 2)",
}
add(
    "filter_by_flag_counts",
    lambda s, d: cl.cleaning_counts(fr.ingested(s, d)).select(*[f"{n}_count" for n in _COUNTS]),
    sql("select " + ", ".join(f"count(*) filter (where {t}) as {n}_count" for n, t in _COUNTS.items()) + " from ingested"),
)
add(
    "conditional_counts",
    lambda s, d: six(cl.cleaning_counts(fr.ingested(s, d))),
    sql(
        "select count(*) as total_rows, "
        + ", ".join(f"count(*) filter (where {t}) as {n}_count" for n, t in _COUNTS.items())
        + ", "
        + ", ".join(f"round(count(*) filter (where {t}) / count(*), 6) as {n}_rate" for n, t in _COUNTS.items())
        + " from ingested"
    ),
)
add(
    "filter_session_value",
    lambda s, d: drill.of_session(fr.ingested(s, d), 2),
    sql(f"select {ALL} from ingested where {num('COD_SES')} = 2"),
)


# --- cleaners ---------------------------------------------------------------------------

add(
    "year_format_detect",
    lambda s, d: fr.ingested(s, d).select("line_no", ff.year_form(F.col("COD_ANU")).alias("cod_anu_format")),
    sql(f"select line_no, {year_form('COD_ANU')} as cod_anu_format from ingested"),
)
add(
    "year_corrected_flag",
    lambda s, d: fr.ingested(s, d).select("line_no", ff.year_corrected(F.col("COD_ANU")).alias("cod_anu_was_corrected")),
    sql(f"select line_no, {year_form('COD_ANU')} <> 'YYYY-YYYY' as cod_anu_was_corrected from ingested"),
)
add(
    "year_normalize",
    lambda s, d: cl.clean_year(fr.ingested(s, d)),
    sql(f"select {ALL} from c1"),
)
_SUCCESSOR = replace(DEFAULT, short_year_successor=True)
add(
    "year_normalize_successor",
    lambda s, d: fr.ingested(s, d).select("line_no", ff.academic_year(F.col("COD_ANU"), _SUCCESSOR).alias("COD_ANU")),
    sql(
        f"select line_no, case {year_form('COD_ANU')} when 'YY/YY' then '20'||substring(COD_ANU, 1, 2)||'-'||"
        f"cast(2001 + try_cast(substring(COD_ANU, 1, 2) as int) as varchar) else {year('COD_ANU')} end as COD_ANU from ingested"
    ),
)
add(
    "year_metrics",
    lambda s, d: six(cl.year_metrics(cleaning.year_audit(fr.ingested(s, d)), "year_read")),
    sql(
        "select count(*) as total_rows, round(count(*) filter (where COD_ANU is null) / count(*), 6) as null_rate, "
        r"round(count(*) filter (where not regexp_matches(COD_ANU, '^\d{4}-\d{4}$')) / count(*), 6) as invalid_rate, "
        f"count(*) filter (where {year_form('year_read')} <> 'YYYY-YYYY') as corrected_rows from c1"
    ),
)
add(
    "student_missing_flag",
    lambda s, d: cl.flag_missing_student(fr.quarantined(s, d), "etu_missing").select("line_no", "etu_missing"),
    sql("select line_no, COD_ETU is null as etu_missing from quarantined"),
)
add(
    "student_business_dedup",
    lambda s, d: cl.clean_student(fr.quarantined(s, d)),
    sql(f"select {ALL} from quarantined qualify row_number() over (partition by {cols(KEY)} order by line_no) = 1"),
)
add(
    "student_session_dup_flag",
    lambda s, d: keys.flag_shared_key(fr.ingested(s, d), ("COD_ETU", "COD_SES"), "dup_session_flag").select(
        "line_no", "dup_session_flag"
    ),
    sql("select line_no, count(*) over (partition by COD_ETU, COD_SES) > 1 as dup_session_flag from ingested"),
)
add(
    "student_metrics",
    lambda s, d: six(cl.student_metrics(fr.quarantined(s, d))),
    sql(
        "select count(*) filter (where COD_ETU is null) as nulls_cod_etu, "
        "round(count(*) filter (where COD_ETU is null) / count(*), 6) as null_rate_cod_etu, "
        f"count(*) - (select count(*) from (select distinct {cols(KEY)} from quarantined)) as business_duplicates_removed, "
        f"count(*) as rows_before, (select count(*) from (select distinct {cols(KEY)} from quarantined)) as rows_after "
        "from quarantined"
    ),
)
add(
    "course_normalize",
    lambda s, d: cl.normalise_course(fr.ingested(s, d)).select("line_no", "COD_ELP"),
    sql("select line_no, upper(trim(COD_ELP)) as COD_ELP from ingested"),
)
add(
    "course_validate",
    lambda s, d: cl.clean_course(fr.quarantined(s, d)).select("line_no", "COD_ELP", "elp_invalid_format"),
    sql(
        f"select line_no, case when not {bad_course('upper(trim(COD_ELP))')} then upper(trim(COD_ELP)) end as COD_ELP, "
        f"{bad_course('upper(trim(COD_ELP))')} as elp_invalid_format from quarantined"
    ),
)


def _rate_sql(flag: str, frame: str) -> str:
    return sql(
        f"select count(*) filter (where {flag}) as invalid_count, "
        f"round(count(*) filter (where {flag}) / count(*), 6) as invalid_rate from {frame}"
    )


add(
    "course_metrics",
    lambda s, d: six(cl.flag_metrics(cl.clean_course(fr.ingested(s, d)), "elp_invalid_format")),
    _rate_sql(bad_course("upper(trim(COD_ELP))"), "ingested"),
)
add(
    "grade_normalize",
    lambda s, d: fr.ingested(s, d).select("line_no", ff.grade_value(F.col("NOT_ELP")).alias("NOT_ELP")),
    sql(f"select line_no, {grade('NOT_ELP')} as NOT_ELP from ingested"),
)
add(
    "grade_missing_by_session",
    lambda s, d: cl.grade_flags(fr.ingested(s, d)).select("line_no", "note_missing_s1", "note_missing_s2"),
    sql(
        f"select line_no, {grade('NOT_ELP')} is null and {integer('COD_SES')} = 1 as note_missing_s1, "
        f"{grade('NOT_ELP')} is null and {integer('COD_SES')} = 2 as note_missing_s2 from ingested"
    ),
)
add(
    "grade_out_of_range",
    lambda s, d: cl.grade_flags(fr.ingested(s, d)).select("line_no", "NOT_ELP", "note_out_of_range"),
    sql(
        f"select line_no, {grade('NOT_ELP')} as NOT_ELP, {grade('NOT_ELP')} < 0 or {grade('NOT_ELP')} > 20 "
        "as note_out_of_range from ingested"
    ),
)
add(
    "grade_status_incoherent",
    lambda s, d: cl.grade_flags(fr.ingested(s, d)).select("line_no", "note_incoherent"),
    sql(
        f"select line_no, (COD_TRE = 'V' and {grade('NOT_ELP')} < 10) or (COD_TRE = 'AJ' and {grade('NOT_ELP')} >= 10) "
        "as note_incoherent from ingested"
    ),
)
add(
    "grade_dedup",
    lambda s, d: cl.clean_grade(cl.clean_course(cl.clean_student(cl.clean_year(fr.ingested(s, d))))),
    sql(f"select {cols(('line_no', *RECORD, *FLAGS[:5]))} from c4d"),
)
add(
    "status_normalize",
    lambda s, d: fr.ingested(s, d).select("line_no", ff.upper_trimmed(F.col("COD_TRE")).alias("COD_TRE")),
    sql("select line_no, upper(trim(COD_TRE)) as COD_TRE from ingested"),
)
_BAD_STATUS = "(COD_TRE is not null and upper(trim(COD_TRE)) not in ('V','AJ','RAT','VAR','ADM','NV','ACAR','ABSN'))"
add(
    "status_validate",
    lambda s, d: cl.clean_status(fr.quarantined(s, d)).select("line_no", "COD_TRE", "cod_tre_invalid", "row_status"),
    sql(
        f"select line_no, case when not {_BAD_STATUS} then upper(trim(COD_TRE)) end as COD_TRE, "
        f"{_BAD_STATUS} as cod_tre_invalid, case when {_BAD_STATUS} then 'FLAGGED' else row_status end as row_status "
        "from quarantined"
    ),
)
_REQUIRED = replace(DEFAULT, status_required=True)
add(
    "status_validate_required",
    lambda s, d: cl.clean_status(fr.quarantined(s, d), _REQUIRED).select("line_no", "COD_TRE", "cod_tre_invalid", "row_status"),
    sql(
        f"select line_no, case when not {_BAD_STATUS} then upper(trim(COD_TRE)) end as COD_TRE, "
        f"COD_TRE is null or {_BAD_STATUS} as cod_tre_invalid, "
        f"case when COD_TRE is null or {_BAD_STATUS} then 'FLAGGED' else row_status end as row_status from quarantined"
    ),
)
_RETAKE = replace(DEFAULT, failed="RAT")
add(
    "grade_status_incoherent_other_code",
    lambda s, d: cl.grade_flags(fr.ingested(s, d), _RETAKE).select("line_no", "note_incoherent"),
    sql(
        f"select line_no, (COD_TRE = 'V' and {grade('NOT_ELP')} < 10) or (COD_TRE = 'RAT' and {grade('NOT_ELP')} >= 10) "
        "as note_incoherent from ingested"
    ),
)
add(
    "status_metrics",
    lambda s, d: six(cl.flag_metrics(cl.clean_status(fr.ingested(s, d)), "cod_tre_invalid")),
    _rate_sql(_BAD_STATUS, "ingested"),
)
add(
    "session_cast",
    lambda s, d: fr.ingested(s, d).select("line_no", to_int(F.col("COD_SES")).alias("COD_SES")),
    sql(f"select line_no, {integer('COD_SES')} as COD_SES from ingested"),
)
_SES = integer("COD_SES")
add(
    "session_validate",
    lambda s, d: cl.clean_session(fr.quarantined(s, d)).select(
        "line_no", "COD_SES", "cod_ses_missing", "cod_ses_invalid", "row_status"
    ),
    sql(
        f"select line_no, case when {_SES} in (1, 2) then {_SES} end as COD_SES, {_SES} is null as cod_ses_missing, "
        f"{_SES} not in (1, 2) as cod_ses_invalid, "
        f"case when {_SES} is null or {_SES} not in (1, 2) then 'FLAGGED' else row_status end as row_status from quarantined"
    ),
)
add(
    "session_metrics",
    lambda s, d: cl.session_metrics(cl.clean_session(fr.ingested(s, d))),
    sql(
        f"select count(*) filter (where {_SES} is null) as missing_count, "
        f"count(*) filter (where {_SES} not in (1, 2)) as invalid_count from ingested"
    ),
)
add(
    "clean_records",
    lambda s, d: cleaning.clean_records(fr.ingested(s, d), carry=("line_no",)),
    sql(f"select {cols(('line_no', *CLEANED))} from cleaned"),
)
add(
    "clean_records_stepwise",
    lambda s, d: cl.run_cleaners(fr.ingested(s, d)).select("line_no", *CLEANED),
    sql(f"select {cols(('line_no', *CLEANED))} from cleaned"),
)
add(
    "clean_records_keep_parse_status",
    lambda s, d: cleaning.clean_records(
        cleaning.with_parse_status(fr.ingested(s, d)), carry=("line_no", "parse_status")
    ),
    sql(f"select {cols(('line_no', *CLEANED), 'c.')}, i.row_status as parse_status from cleaned c join ingested i using (line_no)"),
)


def _mark_blank_student(df):
    return df.withColumn("etu_blank", F.trim("COD_ETU") == "")


add(
    "custom_cleaner",
    lambda s, d: cl.run_cleaners(fr.ingested(s, d), (*cl.CLEANERS, _mark_blank_student)).select(
        "line_no", *CLEANED, "etu_blank"
    ),
    sql(f"select {cols(('line_no', *CLEANED))}, trim(COD_ETU) = '' as etu_blank from cleaned"),
)


# --- joins and pair checks --------------------------------------------------------------

_INGESTED_N = with_number("ingested", "numbered", True)
_LONELY = _INGESTED_N + f", lonely as ({lonely_pairs('numbered', 'ses_number')})"
_MARKED = sql(
    _LONELY + " select line_no, exists (select 1 from lonely l where l.COD_ETU is not distinct from x.COD_ETU "
    "and l.COD_ELP is not distinct from x.COD_ELP) as ses2_without_ses1 from ingested x"
)
add("anti_ses2_without_ses1", lambda s, d: pairs.pairs_without_first(fr.ingested(s, d)), sql(_LONELY + " select * from lonely"))


def _marked(s, d):
    rows = fr.ingested(s, d)
    marked = pairs.mark_pairs(rows, pairs.pairs_without_first(rows), "ses2_without_ses1")
    return marked.select("line_no", "ses2_without_ses1")


add("mark_join_pairs", _marked, _MARKED)
add(
    "ses2_without_ses1_window",
    lambda s, d: pairs.flag_second_without_first(fr.ingested(s, d), "ses2_without_ses1").select(
        "line_no", "ses2_without_ses1"
    ),
    _MARKED,
)
add(
    "ses2_without_ses1_cleaned",
    lambda s, d: pairs.flag_second_without_first(fr.cleaned(s, d), "ses2_without_ses1").select(
        "line_no", "ses2_without_ses1"
    ),
    sql(
        with_number("cleaned", "numbered", False) + f", lonely as ({lonely_pairs('numbered', 'ses_number')})"
        " select line_no, exists (select 1 from lonely l where l.COD_ETU is not distinct from x.COD_ETU "
        "and l.COD_ELP is not distinct from x.COD_ELP) as ses2_without_ses1 from cleaned x"
    ),
)
add(
    "distinct_pairs",
    lambda s, d: pairs.distinct_pairs(fr.ingested(s, d)),
    sql("select distinct COD_ETU, COD_ELP from ingested"),
)


# --- windows ----------------------------------------------------------------------------

add(
    "row_number_business_key",
    lambda s, d: keys.with_row_number(fr.ingested(s, d), KEY, "line_no").select("line_no", "row_number"),
    sql(f"select line_no, row_number() over (partition by {cols(KEY)} order by line_no) as row_number from ingested"),
)
add(
    "dup_flag_keep_first",
    lambda s, d: keys.flag_later_copies(fr.ingested(s, d), KEY, "line_no", "is_copy").select("line_no", "is_copy"),
    sql(f"select line_no, row_number() over (partition by {cols(KEY)} order by line_no) > 1 as is_copy from ingested"),
)
add(
    "dup_flag_keep_all",
    lambda s, d: keys.flag_shared_key(fr.ingested(s, d), KEY, "is_shared").select("line_no", "is_shared"),
    sql(f"select line_no, count(*) over (partition by {cols(KEY)}) > 1 as is_shared from ingested"),
)
add(
    "existence_over_key",
    lambda s, d: pairs.session_presence(fr.ingested(s, d)).select("line_no", "has_s1", "has_s2"),
    sql(
        _INGESTED_N + "select line_no, coalesce(bool_or(ses_number = 1) over (partition by COD_ETU, COD_ELP), false) as has_s1, "
        "coalesce(bool_or(ses_number = 2) over (partition by COD_ETU, COD_ELP), false) as has_s2 from numbered"
    ),
)


# --- order, limit, sample ---------------------------------------------------------------

add(
    "sort_by_keys",
    lambda s, d: drill.sort_by_keys(fr.cleaned(s, d), ("COD_ETU", "COD_ELP", "COD_SES"), "line_no"),
    sql(
        f"select {cols(('line_no', *CLEANED))} from cleaned order by COD_ETU nulls last, COD_ELP nulls last, "
        "COD_SES nulls last, line_no"
    ),
)
add(
    "topk",
    lambda s, d: drill.sort_by_keys(fr.cleaned(s, d), ("COD_ETU", "COD_ELP", "COD_SES"), "line_no").limit(100),
    sql(
        f"select {cols(('line_no', *CLEANED))} from cleaned order by COD_ETU nulls last, COD_ELP nulls last, "
        "COD_SES nulls last, line_no limit 100"
    ),
)
add(
    "sample_rows",
    lambda s, d: sample_rows(fr.cleaned(s, d), 20_000, ("line_no",)),
    sql(f"select {cols(('line_no', *CLEANED))} from cleaned order by md5(line_no||':42'), line_no limit 20000"),
)


# --- unions -----------------------------------------------------------------------------


def _two_parquet_folders(s, d):
    def put(path):
        rows = fr.ingested(s, d)
        write.write_parquet(rows.where("row_status = 'OK'"), f"{path}/ok")
        write.write_parquet(rows.where("row_status <> 'OK'"), f"{path}/fixed")

    return fr.written(s, d, "two_folders", put)


def _union_files(s, d):
    path = _two_parquet_folders(s, d)
    return read.read_folders(s, [f"{path}/ok", f"{path}/fixed"], fr.ingested(s, d).schema)


add("union_files", _union_files, sql(f"select {ALL} from ingested"))

# --- the key operators on other tables --------------------------------------------------

_EVENT_KEY = ("user_id", "event_type")
add(
    "keep_first_events",
    lambda s, d: keys.keep_first(fr.table(s, d, "events").select("event_id", *_EVENT_KEY, "value"), _EVENT_KEY, "event_id"),
    "select event_id, user_id, event_type, value from events "
    "qualify row_number() over (partition by user_id, event_type order by event_id) = 1",
)
add(
    "row_number_event_type",
    lambda s, d: keys.with_row_number(
        fr.table(s, d, "events").select("event_id", "event_type"), ("event_type",), "event_id"
    ),
    "select event_id, event_type, row_number() over (partition by event_type order by event_id) as row_number from events",
)
add(
    "dup_flag_keep_all_documents",
    lambda s, d: keys.flag_shared_key(
        fr.table(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), F.length("text").alias("n")),
        ("digest", "n"),
        "is_shared",
    ).select("doc_id", "is_shared"),
    "select doc_id, count(*) over (partition by text) > 1 as is_shared from documents",
)



def _skipped(s, d):
    """Rows read around the broken part, and how many parts were broken."""
    path = _parts_with_a_broken_one(s, d)
    skipped = read.skipped_parts(s, path, read.ingested_schema())
    # Every name on the list counts: a wrong extra one would show.
    broken = skipped.agg(F.count(F.lit(1))).scalar()
    rows = read.read_parts(s, path, read.ingested_schema()).agg(F.count(F.lit(1)).alias("rows_read"))
    return rows.withColumn("broken_parts", broken)


add("scan_parquet_skipped_parts", _skipped, sql("select count(*) as rows_read, cast(1 as bigint) as broken_parts from ingested"))


def _part_states(s, d):
    """A good part file, one without rows and a damaged one: how many of each state, and their rows."""
    path = new_folder(s, "parts")
    rows = fr.ingested(s, d)
    rows.coalesce(1).write.parquet(path)
    rows.limit(0).write.mode("append").parquet(path)
    write_bytes(s, f"{path}/part-broken.parquet", b"no parquet")
    states = read.part_states(s, path, rows.schema)
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


add(
    "scan_parquet_part_states",
    _part_states,
    sql(
        "select 'whole' as state, 1::bigint as files, count(*) as rows from ingested "
        "union all select 'empty', 1, 0 union all select 'damaged', 1, 0"
    ),
)


# --- columns with signs in their names ----------------------------------------------------

_SIGNS = {"COD_ETU": "cod.etu", "COD_SES": "cod`ses"}


def _with_signs(s, d):
    return fr.ingested(s, d).withColumnsRenamed(_SIGNS)


add(
    "dup_flags_signed_names",
    lambda s, d: keys.flag_shared_key(
        keys.flag_later_copies(_with_signs(s, d), list(_SIGNS.values()), "line_no", "is_copy"), list(_SIGNS.values()), "is_shared"
    ).select("line_no", "is_copy", "is_shared"),
    sql(
        "select line_no, row_number() over (partition by COD_ETU, COD_SES order by line_no) > 1 as is_copy, "
        "count(*) over (partition by COD_ETU, COD_SES) > 1 as is_shared from ingested"
    ),
)
