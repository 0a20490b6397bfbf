"""Score profiles against pandas, golden totals, bounds and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from limpid.operators import cleaners as cl
from limpid.operators import drill, keys, pairs, profile
from limpid.operators.parsing import coerce_numeric, parse_lines, ragged_records
from limpid.operators.quantiles import histogram
from limpid.plans import history, scoring
from limpid.plans.cleaning import clean_records
from limpid.rules import DASHBOARD_ORDER, Rules


@pytest.fixture(scope="module")
def dirty(spark):
    rnd = random.Random(11)
    rows = [
        (
            i,
            rnd.choice(["2015", "2015-2016", "15/16", "", None]),
            rnd.choice(["1", "2", "3", "4", "", None]),
            rnd.choice(["MATH1001", "math1002", "M-1", None, "NULL"]),
            rnd.choice(["12", "9,5", "25", "-3", "ABS", "", None]),
            rnd.choice(["V", "AJ", "RAT", "ABS", "None", "", None]),
            rnd.choice(["1", "2", "1.0", "1.7", "x", "", None]),
            rnd.choice(["OK", "FIXED"]),
        )
        for i in range(400)
    ]
    schema = (
        "line_no long, COD_ANU string, COD_ETU string, COD_ELP string, NOT_ELP string, COD_TRE string, "
        "COD_SES string, row_status string"
    )
    return spark.createDataFrame(rows, schema).cache()


FIVE = [
    # A pair with a copy, a second session without first and without grade, a bad row, a second session without first.
    ("2015", "1", "MATH1001", "12", "V", "1", "OK"),
    ("2015", "1", "MATH1001", "12", "V", "1", "OK"),
    ("2015", "2", "MATH1001", None, "AJ", "2", "FIXED"),
    ("", "3", "M-1", "25", "ZZZ", "x", "OK"),
    ("2015", "4", "MATH1001", "10", "V", "2", "OK"),
]


@pytest.fixture
def five(spark):
    schema = "line_no long, COD_ANU string, COD_ETU string, COD_ELP string, NOT_ELP string, COD_TRE string, COD_SES string, row_status string"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(FIVE)], schema)


def test_dashboard_scores_counted_by_hand(five):
    row = scoring.scores_d(five, helpers=("line_no",)).first()
    assert row["Complétude"] == pytest.approx(94.29, abs=0.0051)  # 80, 100, 100, 80, 100, 100, 100
    assert row["Unicité"] == pytest.approx(80)  # one of five is a copy
    assert row["Cohérence"] == pytest.approx(60)  # rows 3 and 5
    assert row["Validité"] == row["Exactitude"] == pytest.approx(80)  # row 4
    assert row["Distribution"] == pytest.approx(96.02, abs=0.0051)  # shares 2/5, 2/5, 1/5: 1.521928 of 1.584963 bits
    per_column = {r.column_name: r.pct for r in scoring.completeness_d(five.drop("line_no")).collect()}
    assert per_column == pytest.approx(
        {"COD_ANU": 80, "COD_ETU": 100, "COD_ELP": 100, "NOT_ELP": 80, "COD_TRE": 100, "COD_SES": 100, "row_status": 100}
    )


def test_notebook_scores_counted_by_hand(five):
    row = scoring.scores_n(five, helpers=("line_no",)).first()
    assert row["completude"] == pytest.approx(33 / 35)  # two empty cells
    assert row["unicite"] == pytest.approx(0.8)
    assert row["coherence"] == pytest.approx(0.8)  # as shipped, row 3 alone
    assert row["validite"] == pytest.approx(0.6)  # AJ is not on this profile's list, x is no session
    assert row["exactitude"] == pytest.approx(0.6)  # grades 12, 12, 10
    assert row["distribution"] == 1.0
    assert row["schema_integrity"] == pytest.approx(0.8)
    assert scoring.coherence_n(five, Rules(compat=False)).first().score == pytest.approx(0.6)
    # Quartiles of 10, 12, 12, 25 are 11.5 and 15.25, so 5.875 to 20.875 is within reach.
    assert scoring.outlier_score_n(five).first().score == pytest.approx(0.75)


def test_exploration_scores_counted_by_hand(spark):
    lines = ["2015,1,M,12,V,1", "2015,1,M,12,V,1", "15/16,,M,25,V,2", "2015,2,M,ABS,V,x"]
    seven = ragged_records(spark.createDataFrame(list(enumerate(lines)), "line_no long, raw_line string")).drop("line_no", "too_many_fields", "surplus")
    row = scoring.scores_e(coerce_numeric(seven)).first().asDict()
    assert row == pytest.approx(
        {
            "completeness": 75.0,  # 75, 75, 100, 100, 100, 75, 0 and 75 for the numeric grade
            "accuracy": 62.5,  # three sessions and two grades of eight
            "consistency": 75.0,  # the last row has a result without a number
            "uniqueness": 75.0,
            "validity_format": 75.0,  # three years and three students of eight
            "extreme_values": 75.0,  # 25
            "session_distribution": 75.0,
            "global_score": 73.21,  # the mean of the seven
        }
    )


def test_recorded_global_scores(spark):
    """Two recorded score rows and the totals recorded with them (seven dimensions)."""
    names = [*DASHBOARD_ORDER[:6], "Intégrité Schéma"]
    rows = [
        (87.39, 100.0, 99.97, 56.22, 56.22, 63.18, 100.0),
        (90.99, 100.0, 91.64, 99.99, 99.99, 100.0, 100.0),
    ]
    df = spark.createDataFrame(rows, names).withColumn("g", scoring.global_score_d(with_schema=True))
    assert [r.g for r in df.collect()] == [80.31, 96.94]
    six = spark.createDataFrame(rows, names).withColumn("g", scoring.global_score_d())
    assert six.first().g == 60.31


def test_renormalised_score_reaches_100(records):
    best = records([("2015", "1", "M", "12", "V", "1")]).drop("line_no")
    assert scoring.scores_d(best).first().global_score == 80.0
    assert scoring.scores_d(best, renormalize=True).first().global_score == 100.0


def test_scores_by_batch_equal_scores_of_each_batch(dirty):
    batched = dirty.withColumn("batch", F.col("line_no") % 3)
    together = {r.batch: r.asDict() for r in scoring.scores_d(batched, helpers=("line_no",), by=("batch",)).collect()}
    for b in range(3):
        alone = scoring.scores_d(batched.where(F.col("batch") == b).drop("batch"), helpers=("line_no",)).first().asDict()
        row = together[b]
        del row["batch"]
        assert row == pytest.approx(alone)


def test_distribution_edges(spark):
    one = spark.createDataFrame([("1",), ("1",), (None,)], "COD_SES string")
    none = spark.createDataFrame([(None,)], "COD_SES string")
    assert scoring.distribution_d(one).first().score == 100.0
    assert scoring.distribution_d(none).first().score == 0.0
    assert scoring.distribution_d(spark.range(3)).first().score == 100.0


def test_absent_columns(records):
    df = records([("2015", "1", "M", None, "V", "2")])
    assert scoring.uniqueness(df.drop("COD_ETU")).first().score == 1.0
    assert scoring.coherence_d(df.drop("COD_ETU")).first().score == 0.0
    assert df.agg(scoring.validity_d(df.drop("COD_SES")).alias("v")).first().v == 0.0
    assert df.agg(scoring.schema_integrity_d(df.drop("row_status")).alias("v")).first().v == 100.0
    assert drill.duplicate_members(df.select("line_no"), ("COD_ETU",), "line_no").count() == 0


def test_cleaning_invariants(dirty):
    fused = clean_records(dirty, carry=("line_no",))
    steps = cl.run_cleaners(dirty).select(fused.columns)
    assert fused.exceptAll(steps).count() == 0 and steps.exceptAll(fused).count() == 0
    # Cleaned text fields are fixed points of their rules.
    again = fused.select(
        (cl.ff.academic_year(F.col("COD_ANU")).eqNullSafe(F.col("COD_ANU")) | F.col("COD_ANU").isNull()).alias("y"),
        cl.ff.upper_trimmed(F.col("COD_ELP")).eqNullSafe(F.col("COD_ELP")).alias("e"),
    )
    assert again.where("not (y and e)").count() == 0
    scores = scoring.scores_d(fused, helpers=("line_no",)).first()
    assert all(0 <= scores[c] <= 100 for c in DASHBOARD_ORDER)


def test_every_input_line_is_accounted_for(lines):
    texts = ["COD_ANU,COD_ETU,COD_ELP,NOT_ELP,COD_TRE,COD_SES", "1,2,3,4,5,6", "1,2,3,4,4,5,6", "x", "", "1,2,3,4,5,6,7,8"]
    raw = lines(texts)
    kept, all_rows = parse_lines(raw), parse_lines(raw, keep_invalid=True)
    assert all_rows.count() == len(texts) - 1
    assert kept.count() + all_rows.where("row_status = 'INVALID'").count() == len(texts) - 1


def test_empty_tables(records, lines, spark):
    """Every operator takes a table without rows."""
    empty = records([("", "", "", "", "", "")]).limit(0)
    cleaned = clean_records(empty, carry=("line_no",))
    for rows in (
        cleaned,
        cl.run_cleaners(empty),
        keys.with_row_number(empty, ("COD_ETU",), "line_no"),
        keys.flag_shared_key(empty, ("COD_ETU",), "f"),
        keys.flag_later_copies(empty, ("COD_ETU",), "line_no", "f"),
        pairs.pairs_without_first(empty),
        pairs.flag_second_without_first(empty, "f"),
        drill.first_incomplete_rows(empty, "line_no", 100),
        drill.duplicate_members(empty, ("COD_ETU",), "line_no"),
        profile.top_values(empty, "COD_SES", 20),
        profile.value_counts(empty, "COD_SES"),
        profile.missing_correlation(empty),
        profile.sample_rows(empty, 5, ["line_no"]),
        parse_lines(lines(["x"]).limit(0)),
        ragged_records(lines(["x"]).limit(0)),
    ):
        assert rows.collect() == []
    assert cl.cleaning_counts(empty).first().total_rows == 0
    assert cl.student_metrics(empty).first().asDict() == {
        "nulls_cod_etu": 0, "null_rate_cod_etu": 0.0, "business_duplicates_removed": 0, "rows_before": 0, "rows_after": 0,
    }
    assert cl.flag_metrics(cleaned, "elp_invalid_format").first().invalid_rate is None
    assert scoring.coherence_d(empty).first().score == 100.0
    assert scoring.uniqueness(empty).first().score is None
    assert scoring.scores_n(empty, helpers=("line_no",)).first().completude is None
    assert scoring.scores_d(empty, helpers=("line_no",)).first()["Distribution"] == 0.0
    assert scoring.outlier_score_n(empty).first().score is None
    assert scoring.scores_e(coerce_numeric(ragged_records(lines(["x"]).limit(0))), helpers=("line_no", "too_many_fields")).count() == 1
    assert profile.column_profile(empty).count() == 0
    assert {r.missing for r in profile.missing_counts(empty).collect()} == {0}
    assert sum(r["count"] for r in histogram(spark.createDataFrame([], "x double"), "x").collect()) == 0


def test_history_rules(spark):
    old = spark.createDataFrame([("2026-01-01", 1.0)], "timestamp string, global_score double")
    new = spark.createDataFrame([("2026-01-02", "raw", 2.0, 3.0)], "timestamp string, stage string, global_score double, extra double")
    both = history.extend(old, new)
    assert {(r.stage, r.global_score, r.extra) for r in both.collect()} == {("cleaned", 1.0, None), ("raw", 2.0, 3.0)}
    assert history.latest_pair(both).count() == 2
    assert history.latest_pair(history.of_stage(both, "raw")).count() == 0
    assert history.melt_scores(both).count() == 2


def test_compare_counts_a_missing_score_as_zero(spark):
    before = spark.createDataFrame([(50.0, 1.0)], "a double, global_score double")
    after = spark.createDataFrame([(40.0, 7.0, 2.0)], "a double, b double, global_score double")
    rows = {r.dimension: tuple(r)[1:] for r in history.compare(before, after, shown=True).collect()}
    assert rows == {"a": ("50.00%", "40.00%", "-10.00%"), "b": ("0.00%", "7.00%", "+7.00%")}


def test_utc_now_ignores_the_session_zone(spark):
    from datetime import UTC, datetime

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        now = spark.range(1).select(history.utc_now().alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs((datetime.now(UTC).replace(tzinfo=None) - now).total_seconds()) < 60


def _scans(df, capsys):
    df.explain()
    return capsys.readouterr().out.count("FileScan")


def test_a_score_row_reads_its_table_twice(dirty, spark, tmp_path, capsys):
    dirty.withColumn("batch", F.col("line_no") % 3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    alone = df.drop("batch")
    assert _scans(scoring.scores_d(df, helpers=("line_no",), by=("batch",)), capsys) == 2
    assert _scans(scoring.scores_n(alone, Rules(compat=False), helpers=("line_no",)), capsys) <= 2
    for frame in (scoring.scores_d(alone), scoring.scores_n(alone)):
        text = frame._jdf.queryExecution().optimizedPlan().toString()
        frame.explain("simple")
        assert capsys.readouterr().out.count("FileScan") <= 2, text
    both = history.compare(scoring.scores_d(df.where("batch = 0").drop("batch")), scoring.scores_d(df.where("batch = 1").drop("batch")))
    assert _scans(both, capsys) <= 4


def test_rows_come_with_the_scores(dirty):
    before, after = (scoring.scores_d(x, helpers=("line_no",), with_rows=True) for x in (dirty, dirty.where("line_no < 100")))
    row = history.kpi_delta(before, after).first()
    assert (row.rows, row.rows_delta) == (100, -300)
    assert row.global_delta == pytest.approx(after.first().global_score - before.first().global_score)
    assert {r.dimension for r in history.compare(before, after).collect()} == set(DASHBOARD_ORDER[:6])


def test_completeness_of_odd_columns(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1, "x", 2.0), (3.0, None, " ", None), (nan, 2, "NULL", None), (None, 3, None, 1.0)], "`a.b` double, `mean_pct` int, `c``d` string, pct float")
    d = {r.column_name: (r.pct, r.mean_pct) for r in scoring.completeness_d(df).collect()}
    assert d == {"a.b": (25.0, 43.75), "mean_pct": (75.0, 43.75), "c`d": (25.0, 43.75), "pct": (50.0, 43.75)}
    e = {r.column_name: (r.pct, r.mean_pct) for r in scoring.completeness_e(df).collect()}
    assert e == {"a.b": (25.0, 56.25), "mean_pct": (75.0, 56.25), "c`d": (75.0, 56.25), "pct": (50.0, 56.25)}
    assert {r.column_name: r.pct for r in scoring.completeness_d(df, helpers=("a.b",)).collect()}.keys() == {"mean_pct", "c`d", "pct"}


def test_scores_without_session_or_status(spark):
    df = spark.createDataFrame([("1", "M", "1"), ("1", "M", "2")], "COD_ETU string, COD_ELP string, COD_SES string").withColumn("NOT_ELP", F.lit("9")).withColumn("COD_TRE", F.lit("V"))
    row = scoring.scores_d(df, with_schema=True, with_rows=True).first()
    assert (row.rows, row["Distribution"], row["Intégrité Schéma"]) == (2, 100.0, 100.0)
    empty = scoring.scores_d(df.limit(0), with_schema=True, with_rows=True).first()
    assert (empty.rows, empty["Distribution"], empty["Complétude"], empty["Cohérence"]) == (0, 0.0, None, 100.0)
