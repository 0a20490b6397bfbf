"""The whole job over files, and the row-local part of it over a stream."""

from pyspark.sql import functions as F

from limpid.operators.parsing import parse_lines
from limpid.plans.cleaning import clean_records, error_flags
from limpid.plans.history import by_time, compare, history_row, latest_pair, melt_scores
from limpid.plans.scoring import scores_d
from limpid.sources import read, write

TEXT = """COD_ANU,COD_ETU,COD_ELP,NOT_ELP,COD_TRE,COD_SES
2015,1,MATH1001,14.5,V,1
2015,1,math1001,14,5,V,1
15/16,2,MATH1001,9,V,2
2015-2016,2,MATH1002,,AJ,1
broken line
AN2015,3,MAT-1,30,XX,3
"""


def test_files_from_raw_text_to_history(spark, tmp_path):
    (tmp_path / "raw.txt").write_text(TEXT)
    lines = read.read_lines(spark, str(tmp_path / "raw.txt"))
    assert write.write_parquet(parse_lines(lines), str(tmp_path / "ingested"), legacy=True) == 5
    records = read.read_ingested(spark, str(tmp_path / "ingested"))

    clean = clean_records(records, carry=("line_no",))
    assert write.write_csv(clean.drop("line_no"), str(tmp_path / "cleaned")) == 4
    stored = read.read_csv_files(spark, str(tmp_path / "cleaned"), read.cleaned_schema())
    assert stored.exceptAll(clean.drop("line_no")).count() == 0
    by_student = {(r.COD_ETU, r.COD_ELP): r for r in stored.collect()}
    assert by_student[("1", "MATH1001")].NOT_ELP == 14.5
    assert by_student[("3", None)].row_status == "FLAGGED"

    before, after = scores_d(records, helpers=("line_no",)), scores_d(stored)
    gains = {r.dimension: r.gain for r in compare(before, after).collect()}
    assert set(gains) == set(before.columns) - {"global_score"}
    path = str(tmp_path / "history")
    for stage, scores, at in (("raw", before, "2026-01-06T10:00:00"), ("cleaned", after, "2026-01-06T11:00:00")):
        write.append_history(history_row(scores, stage, F.lit(at).cast("timestamp_ntz")), path)
    history = read.read_history(spark, path)
    assert [r.stage for r in by_time(history).collect()] == ["raw", "cleaned"]
    assert melt_scores(latest_pair(history)).count() == 14


def test_row_local_functions_accept_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "raw.txt").write_text(TEXT)
    stream = spark.readStream.text(str(source)).withColumnRenamed("value", "raw_line")
    query = (
        error_flags(parse_lines(stream))
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(60)
    batch = error_flags(parse_lines(spark.read.text(str(source)).withColumnRenamed("value", "raw_line")))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == 5
    assert streamed.exceptAll(batch).count() == 0
