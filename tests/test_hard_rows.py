"""Rows that plain tables don't have: infinities, NaN, odd names, damaged files, other column orders, surplus fields."""

import math

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.operators import drill, parsing, profile
from limpid.operators.quantiles import histogram, quantiles
from limpid.rules import Rules
from limpid.sources import read, write

INF = float("inf")


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_quantiles_with_infinities(spark):
    df = numbers(spark, [1.0, 2.0, 3.0, INF, -INF, None, float("nan")])
    assert tuple(quantiles(df, "x", [0, 0.25, 0.5, 0.75, 1]).first()) == (-INF, 1.0, 2.0, 3.0, INF)
    big = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, INF).when(F.col("id") % 4 == 1, -INF).otherwise(F.col("id").cast("double")).alias("x"))
    got = quantiles(big, "x", [0.1, 0.5, 0.9]).first()
    assert got[0] == -INF and got[2] == INF and 19_990 < got[1] < 20_010
    assert tuple(quantiles(numbers(spark, [-1.7e308, 0.0, 1.7e308]), "x", [0.5]).first()) == (0.0,)
    assert tuple(quantiles(numbers(spark, []), "x", [0, 0.5, 1]).first()) == (None, None, None)


def test_histogram_shows_infinite_values_apart(spark):
    rows = histogram(numbers(spark, [1.0, 2.0, 2.0, INF, -INF, -INF]), "x", 2).orderBy("bin").collect()
    assert [(r.bin, r["count"]) for r in rows] == [(-1, 2), (0, 1), (1, 2), (2, 1)]
    assert rows[0].low == -INF and rows[3].high == INF


def test_nan_is_missing(spark):
    df = numbers(spark, [1.0, 2.0, float("nan")])
    assert profile.missing_counts(df).first().missing == 1
    row = profile.describe_numeric(df, "x").first()
    assert (row["count"], row["mean"], row["max"], row["p50"]) == (2, 1.5, 2.0, 1.5)
    assert profile.column_profile(df).first().missing == 1
    assert drill.incomplete_rows(df).count() == 1


def test_names_with_signs(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 2.0), (1, "a", 2.0)], "`a.b` int, rows string, `mean_pct` double")
    assert {r.column_name: r.missing for r in profile.missing_counts(df).collect()} == {"a.b": 0, "rows": 0, "mean_pct": 1}
    assert profile.duplicate_rows(df).first()[0] == 1
    assert {r.column_name: r.top_count for r in profile.column_profile(df).collect()} == {"a.b": 3, "rows": 3, "mean_pct": 2}
    assert profile.missing_total(df).first()[0] == 1


def test_no_column_is_left_out(spark):
    names = [f"c{i}" for i in range(45)]
    df = spark.range(90).select(*[F.when(F.col("id") % 45 != i, 1).alias(n) for i, n in enumerate(names)])
    assert profile.missing_rank(df).count() == 45 and profile.missing_rank(df, 5).count() == 5
    assert profile.missing_correlation(df).count() == 45 * 44 // 2
    assert profile.missing_correlation(df, limit=5).count() == 10


def test_correlation_of_billions_of_rows(spark, monkeypatch):
    df = spark.createDataFrame([(None, 1), (None, None), (1, None), (1, 1)], "a int, b int")
    small = profile.missing_correlation(df).first()["corr"]
    monkeypatch.setattr(profile, "_rows", lambda: F.count(F.lit(1)) * F.lit(3_200_000_000))
    assert profile.missing_correlation(df).first()["corr"] == pytest.approx(small, abs=1e-9)


def test_sample_is_the_lowest_digests(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    got = {r.k for r in profile.sample_rows(df, 100, ["k"]).collect()}
    marks = df.withColumn("m", F.md5(F.concat_ws(":", "k", F.lit(42)))).orderBy("m").limit(100)
    assert got == {r.k for r in marks.collect()}
    assert profile.sample_rows(df, 9000, ["k"]).count() == 5000 and profile.sample_rows(df, 0, ["k"]).count() == 0


@pytest.mark.parametrize("mark", ["|", ".", "\t", ";", "||"])
def test_any_delimiter(spark, lines, mark):
    line = mark.join(["2015", "1", "MATH1001", "14", "V", "1"])
    row = parsing.parse_lines(lines([line]), Rules(delimiter=mark)).first()
    assert (row.row_status, row.COD_ELP, row.COD_SES) == ("OK", "MATH1001", "1")


def test_surplus_fields_are_kept_and_quotes_respected(spark, lines, tmp_path):
    texts = ['2015,1,"MATH,1001",14,V,1,', "2015,1,M,14,V,1,x,y,z", '2015,1,M,14,V,1,"a,b","c,d",e', "2015,1,M"]
    want = [None, "y,z", '"c,d",e', None]
    got = sorted(parsing.ragged_records(lines(texts)).collect(), key=lambda r: r.line_no)
    assert [r.surplus for r in got] == want and [r.too_many_fields for r in got] == [w is not None for w in want]
    assert got[0].COD_ELP == "MATH,1001" and got[0].EXTRA is None
    (tmp_path / "a.csv").write_text("\n".join(texts) + "\n")
    assert sorted(map(str, (r.surplus for r in read.read_ragged(spark, str(tmp_path)).collect()))) == sorted(map(str, want))


def test_csv_files_bound_by_name(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "1.csv").write_text("p,q\n1,2\n")
    (tmp_path / "2.csv").write_text("q,p\n2,1\n")
    (tmp_path / "sub" / "3.csv").write_text('q,"other, name"\n2,9\n')
    schema = T.StructType([T.StructField("p", T.StringType()), T.StructField("q", T.IntegerType())])
    got = sorted(map(tuple, read.read_csv_files(spark, str(tmp_path), schema).collect()), key=str)
    assert got == [("1", 2), ("1", 2), (None, 2)]


def test_damaged_part_is_left_out_whole_and_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("s"))
    for k in range(2):
        df.coalesce(1).write.mode("append").option("parquet.block.size", 1 << 20).option("compression", "none").parquet(path)
    parts = sorted((tmp_path / "t").glob("part-*.parquet"))
    raw = bytearray(parts[0].read_bytes())
    meta = pq.ParquetFile(parts[0]).metadata
    assert meta.num_row_groups > 2
    at = meta.row_group(2).column(1).dictionary_page_offset or meta.row_group(2).column(1).data_page_offset
    raw[at : at + 64] = b"\xff" * 64
    parts[0].write_bytes(bytes(raw))
    for crc in (tmp_path / "t").glob(".part*.crc"):
        crc.unlink()
    assert read.read_parts(spark, path, df.schema).count() == 200_000
    assert [r.path.rsplit("/", 1)[1] for r in read.skipped_parts(spark, path, df.schema).collect()] == [parts[0].name]


def test_plain_write_leaves_the_session_alone(spark, tmp_path):
    setting = "spark.sql.parquet.writeLegacyFormat"
    spark.conf.set(setting, "true")
    try:
        write.write_parquet(spark.range(3).toDF("x"), str(tmp_path / "x"))
        assert spark.conf.get(setting) == "true"
    finally:
        spark.conf.unset(setting)
    assert not math.isnan(write.write_parquet(spark.range(3).toDF("x"), str(tmp_path / "y"), legacy=True))
    assert spark.conf.get(setting) == "false"
