"""Readers and writers against real files."""

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from limpid.rules import DASHBOARD_ORDER
from limpid.sources import read, shared, write

LINE = ("2015", "1", "MATH1001", "14.5", "V", "1")


def test_lenient_reader_drops_bad_bytes_and_splits_as_python_does(spark, tmp_path):
    raw = b"a\xffb\r\nc\x0bd\x0b\nplain \xc3\xa9\n\nlast"
    path = tmp_path / "raw.txt"
    path.write_bytes(raw)
    expected = raw.decode("utf-8", errors="ignore").splitlines()
    rows = read.read_lines_lenient(spark, str(path)).orderBy("line_no").collect()
    assert [r.raw_line for r in rows] == expected


def test_line_numbers_are_unique_and_in_file_order(spark, tmp_path):
    path = tmp_path / "raw.txt"
    path.write_text("\n".join(f"line {i:05d}" for i in range(2000)))
    rows = read.read_lines(spark, str(path)).orderBy("line_no").collect()
    assert [r.raw_line for r in rows] == [f"line {i:05d}" for i in range(2000)]


def test_unreadable_parts_are_skipped_and_named(spark, records, tmp_path):
    path = str(tmp_path / "parts")
    rows = records([LINE, LINE]).drop("line_no").coalesce(1)
    assert write.write_parquet(rows, path) == 2
    shared.write_bytes(spark, f"{path}/part-broken.parquet", b"no parquet")
    shared.write_bytes(spark, f"{path}/other.parquet", b"not a part")
    schema = read.ingested_schema()
    assert read.read_parts(spark, path, schema).count() == 2
    skipped = [r.path for r in read.skipped_parts(spark, path, schema).collect()]
    assert len(skipped) == 1 and skipped[0].endswith("part-broken.parquet")


def test_parts_in_subfolders_are_found_when_there_are_none_above(spark, records, tmp_path):
    rows = records([LINE]).drop("line_no")
    write.write_parquet(rows, str(tmp_path / "deep" / "one"))
    write.write_parquet(rows, str(tmp_path / "deep" / "two"))
    assert read.read_parts(spark, str(tmp_path / "deep"), read.ingested_schema()).count() == 2


def test_missing_paths_give_empty_tables(spark, tmp_path):
    gone = str(tmp_path / "gone")
    assert read.read_or_empty(spark, gone, read.ingested_schema()).count() == 0
    assert read.read_parts(spark, gone, read.ingested_schema()).count() == 0
    assert read.read_csv_files(spark, gone, read.cleaned_schema()).columns == read.cleaned_schema().names


def test_write_replaces_and_keeps_settings(spark, records, tmp_path):
    path = str(tmp_path / "out")
    before = spark.conf.get("spark.sql.parquet.writeLegacyFormat")
    assert write.write_parquet(records([LINE, LINE, LINE]), path, legacy=True) == 3
    assert write.write_parquet(records([LINE]), path) == 1
    assert spark.read.parquet(path).count() == 1
    assert spark.conf.get("spark.sql.parquet.writeLegacyFormat") == before
    assert write.write_csv(records([LINE, LINE]), str(tmp_path / "csv")) == 2


def test_history_grows_by_name(spark, tmp_path):
    path = str(tmp_path / "history")
    write.append_history(spark.createDataFrame([("t1", 1.0)], "timestamp string, global_score double"), path)
    write.append_history(
        spark.createDataFrame([("t2", "raw", 2.0, 3.0)], "timestamp string, stage string, global_score double, extra double"),
        path,
    )
    rows = {(r.timestamp, r.stage, r.global_score, r.extra) for r in read.read_history(spark, path).collect()}
    assert rows == {("t1", "cleaned", 1.0, None), ("t2", "raw", 2.0, 3.0)}


def test_history_csv_time_is_parsed(spark, tmp_path):
    path = tmp_path / "history.csv"
    names = list(DASHBOARD_ORDER)
    path.write_text(
        ",".join(["timestamp", "stage", *names]) + "\n2026-01-06T14:14:34.375670,raw,87.39,100.0,99.97,56.22,56.22,63.18,80.31\n"
    )
    row = read.read_history_csv(spark, str(path), names).first()
    assert row.timestamp.isoformat() == "2026-01-06T14:14:34.375670" and row.global_score == 80.31


def test_shared_folder_comes_from_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared.shared_root(spark) == root
    assert shared.new_folder(spark, "x").startswith(root)
    assert not shared.exists(spark, shared.new_folder(spark, "x"))


@pytest.mark.parametrize("pattern,found", [("part-*.parquet", True), ("*.csv", False)])
def test_has_files(spark, records, tmp_path, pattern, found):
    write.write_parquet(records([LINE]), str(tmp_path / "p"))
    assert shared.has_files(spark, str(tmp_path / "p"), pattern) is found


def test_empty_and_damaged_parts_are_told_apart(spark, records, tmp_path):
    path = str(tmp_path / "parts")
    rows = records([LINE, LINE]).drop("line_no").coalesce(1)
    schema = read.ingested_schema()
    rows.write.parquet(path)
    rows.limit(0).write.mode("append").parquet(path)
    shared.write_bytes(spark, f"{path}/part-broken.parquet", b"no parquet")
    shared.write_bytes(spark, f"{path}/part-nothing.parquet", b"PAR1")
    whole = next((tmp_path / "parts").glob("part-0*.parquet")).read_bytes()
    shared.write_bytes(spark, f"{path}/part-cut.parquet", whole[:-5])
    found = {r.path.rsplit("/", 1)[1][:8]: (r.state, r.rows) for r in read.part_states(spark, path, schema).collect() if "part-0" not in r.path}
    assert found == {"part-bro": ("damaged", None), "part-not": ("damaged", None), "part-cut": ("damaged", None)}
    states = [r.state for r in read.part_states(spark, path, schema).collect() if "part-0" in r.path]
    assert sorted(states) == ["empty", "whole"]
    assert read.read_parts(spark, path, schema).count() == 2 and read.skipped_parts(spark, path, schema).count() == 3


def test_parts_are_read_without_a_shuffle(spark, records, tmp_path, capsys):
    path = str(tmp_path / "parts")
    records([LINE, LINE]).drop("line_no").coalesce(1).write.parquet(path)
    shared.write_bytes(spark, f"{path}/part-broken.parquet", b"no parquet")
    read.read_parts(spark, path, read.ingested_schema()).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan") == 1


def test_an_append_may_be_repeated(spark, tmp_path):
    path = str(tmp_path / "history")
    row = lambda t: spark.createDataFrame([(t, 1.0)], "timestamp string, global_score double")
    assert write.append_history(row("t0"), path)  # rows without a batch, as before
    assert write.append_history(row("t1"), path, "b1")
    assert not write.append_history(row("t1"), path, "b1")
    assert write.append_history(row("t2"), path, "b2")
    assert sorted(r.timestamp for r in read.read_history(spark, path).collect()) == ["t0", "t1", "t2"]


def test_folders_can_be_removed(spark):
    before = dict(shared._made)
    shared._made.clear()
    try:
        table = shared.stored_table(spark.range(3), "x")
        folder = shared._made[spark.sparkContext.applicationId][-1]
        assert table.count() == 3 and shared.exists(spark, folder)
        assert shared.remove_folders(spark) == 1 and not shared.exists(spark, folder)
        assert shared.remove_folders(spark) == 0
    finally:
        shared._made.update(before)


@pytest.mark.parametrize("named", [True, False])
def test_folders_go_with_the_driver(tmp_path, named):
    """A session of its own; whether the shared folder is named or made by the session."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark.sql import SparkSession
from limpid.sources.shared import stored_table
b = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
spark = (b.config("spark.checkpoint.dir", {str(tmp_path)!r}) if {named} else b).getOrCreate()
print(stored_table(spark.range(3), "x").inputFiles()[0])
"""
    env = {**os.environ, "TMPDIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, env=env)
    assert "limpid-" in out.stdout, out.stderr[-2000:]
    for _ in range(40):  # the JVM may end a little later
        if not list(tmp_path.glob("limpid-*")):
            break
        time.sleep(0.25)
    assert not list(tmp_path.glob("limpid-*"))


def test_stored_tables_are_short_files(spark, tmp_path, monkeypatch):
    """A later task reads some files: rows in it are bounded by rows in a file, however well they compress."""
    from limpid.catalog import frames

    monkeypatch.setattr(frames, "ROWS_PER_FILE", 100)
    rows = frames._stored(spark, str(tmp_path), "short", lambda s, d: s.range(0, 1050, 1, 2).withColumn("x", F.lit("x")))
    per_file = [r["n"] for r in rows.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert max(per_file) == 100 and sorted(r["id"] for r in rows.collect()) == list(range(1050))
