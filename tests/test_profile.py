"""Quantiles, histograms and profiles against numpy and pandas."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from limpid.operators import profile
from limpid.operators.quantiles import histogram, quantiles

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def _quantiles(spark, values, accuracy=10_000):
    return list(quantiles(_frame(spark, values), "x", PROBABILITIES, accuracy).first())


@pytest.mark.parametrize(
    "values",
    [
        [random.Random(1).gauss(0, 1) for _ in range(5000)],
        [random.Random(2).randrange(5) for _ in range(5000)],
        [1e9 * 2 ** -random.Random(i).randrange(60) for i in range(3000)],
        [7.0] * 2000,
    ],
)
def test_quantiles_with_narrow_brackets(spark, values):
    """A low accuracy makes the brackets a small part of the table, as on large ones."""
    assert _quantiles(spark, values, accuracy=200) == pytest.approx(np.quantile(values, PROBABILITIES), rel=1e-12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_quantiles_of_few_values(spark, values):
    assert _quantiles(spark, values) == pytest.approx(np.quantile(values, PROBABILITIES), rel=1e-9, abs=1e-9)


def test_quantiles_ignore_missing_values(spark):
    assert _quantiles(spark, [None, 1, float("nan"), 3])[3] == 2.0
    assert _quantiles(spark, [None]) == [None] * len(PROBABILITIES)


@pytest.mark.parametrize("values", [[1, 2, 2, 3.3, 10], [5, 5, 5], list(np.linspace(0, 1, 101)), [0.1 * i for i in range(40)]])
def test_histogram_as_numpy(spark, values):
    counts, edges = np.histogram(values, bins=20)
    rows = histogram(_frame(spark, values), "x").orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(counts)
    assert [r.low for r in rows] + [rows[-1].high] == pytest.approx(list(edges))


@pytest.fixture(scope="module")
def mixed(spark):
    rnd = random.Random(3)
    rows = [
        (
            rnd.choice([None, "a", "b", "c"]),
            rnd.choice([None, 9, 10, 11]),
            rnd.choice([None, 1.5, 2.5]) if i % 2 else None,
            rnd.choice([True, False]),
        )
        for i in range(500)
    ]
    return spark.createDataFrame(rows, "s string, i int, d double, b boolean")


def test_column_profile_as_pandas(mixed):
    pdf = mixed.toPandas()
    rows = {r.column_name: r for r in profile.column_profile(mixed).collect()}
    for c in pdf.columns:
        assert rows[c].distinct_count == pdf[c].nunique()
        assert rows[c].missing == pdf[c].isna().sum()
        top = pdf[c].mode()[0]
        assert rows[c].top_value == (str(top).lower() if c == "b" else str(int(top)) if c == "i" else str(top))


def test_top_value_ties_go_to_the_smallest_number(spark):
    df = spark.createDataFrame([(10,), (9,)], "i int")
    assert profile.column_profile(df).first().top_value == "9"


def test_missing_correlation_as_pandas(mixed):
    expected = mixed.toPandas()[["s", "i", "d"]].isna().astype(int).corr()
    rows = profile.missing_correlation(mixed).collect()
    assert len(rows) == 3
    for r in rows:
        assert r["corr"] == pytest.approx(expected.loc[r.col_a, r.col_b])


def test_missing_correlation_keeps_the_worst_columns(mixed):
    rows = profile.missing_correlation(mixed, limit=2).collect()
    worst = mixed.toPandas().isna().sum().sort_values(ascending=False).index[:2]
    assert len(rows) == 1 and {rows[0].col_a, rows[0].col_b} == set(worst)


def test_correlation_with_an_always_missing_column_is_null(spark):
    df = spark.createDataFrame([(None, 1), (None, None)], "a int, b int")
    assert profile.missing_correlation(df).first()["corr"] is None


def test_describe_as_pandas(mixed):
    expected = mixed.toPandas()["d"].describe()
    row = profile.describe_numeric(mixed, "d").first()
    assert list(row) == pytest.approx(list(expected))


def test_duplicate_rows(mixed, spark):
    assert profile.duplicate_rows(mixed).first()[0] == mixed.toPandas().duplicated().sum()
    texts = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "t string")
    assert profile.duplicate_texts(texts, "t").first()[0] == 2


def test_shown_values_of_numeric_columns_with_many_values(spark):
    many = spark.range(60).select(F.col("id").cast("int").alias("i"), F.col("id").cast("string").alias("s"))
    assert profile.shown_values(many, "i", 20).count() == 20
    assert profile.shown_values(many, "s", 20).count() == 20


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000)
    once, again = profile.sample_rows(df, 700, ["id"]), profile.sample_rows(df.repartition(5), 700, ["id"])
    assert once.count() == 700
    assert {r.id for r in once.collect()} == {r.id for r in again.collect()}
    assert profile.sample_rows(df, 9000, ["id"]).count() == 5000


def test_table_info_and_missing(mixed):
    pdf = mixed.toPandas()
    assert {r.column_name: r.non_null for r in profile.table_info(mixed).collect()} == dict(pdf.notna().sum())
    assert profile.missing_total(mixed).first()[0] == pdf.isna().sum().sum()


def _long_texts(spark):
    """Texts that share their first hundred characters, many of them equally frequent."""
    rnd = random.Random(9)
    texts = ["same beginning " * 8 + str(rnd.randrange(10**9)) for _ in range(300)]
    rows = [(t, rnd.choice(["x", "y"]), i) for i, t in enumerate(texts * 2)]
    rows += [(texts[0] + "rare", None, None), (None, "y", 7)]
    return spark.createDataFrame(rows, "`long.text` string, s string, i int").repartition(5)


@pytest.mark.parametrize("fetched", [1, 7, 10_000])
def test_smallest_of_many_frequent_long_texts(spark, fetched):
    df = _long_texts(spark)
    pdf = df.toPandas()
    rows = {r.column_name: r for r in profile.column_profile(df, fetched=fetched).collect()}
    for c in pdf.columns:
        assert rows[c].distinct_count == pdf[c].nunique() and rows[c].missing == pdf[c].isna().sum()
        assert rows[c].top_count == pdf[c].value_counts().max()
    assert rows["long.text"].top_value == min(pdf["long.text"].value_counts()[lambda n: n == 2].index)
    assert rows["i"].top_value == "7" and rows["s"].top_value == pdf["s"].mode()[0]


def test_long_and_short_texts_in_a_tie(spark):
    long = "b" * 100
    for values, top in (([long, "c"], long), ([long, "a"], "a"), ([long, long, "a", "a"], "a"), ([long, long, "c", "c", "a"], long)):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "t string")
        row = profile.column_profile(df).first()
        assert (row.top_value, row.missing, row.distinct_count) == (top, 1, len(set(values)))


def test_unique_long_texts(spark):
    df = spark.range(500).selectExpr("concat(repeat('x', 60), id) as t", "cast(id as decimal(38, 2)) * 1000000000000000000000000000000 as d")
    rows = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert rows["t"].top_value == "x" * 60 + "0" and rows["t"].distinct_count == 500
    assert float(rows["d"].top_value) == 0 and rows["d"].distinct_count == 500


def test_no_long_text_is_shuffled(spark, capsys):
    """Before the exchange of the counts each cell is a number, a short text or a digest."""
    df = _long_texts(spark)
    keyed = profile._keyed(profile._cells(df, df.columns))
    keyed.groupBy("c", "num", "short", "digest").count().explain()
    plan = capsys.readouterr().out
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "value" not in exchange
    assert keyed.where("octet_length(short) > 32 or octet_length(digest) > 16").isEmpty()


def _scans(df, capsys):
    df.explain()
    return capsys.readouterr().out.count("FileScan")


def test_reads_do_not_grow_with_the_columns(spark, tmp_path, capsys):
    from limpid.operators.quantiles import column_quantiles

    wide = spark.range(2000).select(*[(F.col("id") * (i + 1) % 97).alias(f"n{i}") for i in range(40)])
    wide.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    few, many = (column_quantiles(df, df.columns[:n], [0.25, 0.75]) for n in (2, 40))
    assert _scans(few, capsys) == _scans(many, capsys)
    pdf = df.toPandas()
    for r in profile.describe_all(df).collect():
        e = pdf[r.column_name].describe()
        assert [r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]] == pytest.approx(list(e))


def test_quantiles_of_columns_of_all_sorts(spark):
    from limpid.operators.quantiles import column_quantiles

    rnd = random.Random(4)
    rows = [(rnd.gauss(0, 1), None, rnd.randrange(3), float("inf") if i % 5 else -1.0, float("nan")) for i in range(4000)]
    df = spark.createDataFrame(rows, "`a.b` double, none int, few long, inf float, nan double")
    got = {r.column_name: r for r in column_quantiles(df, df.columns, PROBABILITIES, accuracy=200).collect()}
    assert got["a.b"].q == pytest.approx(np.quantile([r[0] for r in rows], PROBABILITIES), rel=1e-12)
    assert got["few"].q == pytest.approx(np.quantile([r[2] for r in rows], PROBABILITIES))
    assert got["none"].q == got["nan"].q == [None] * len(PROBABILITIES) and got["nan"]["count"] == 0
    assert got["inf"].q == [-1.0, -1.0, *[float("inf")] * 5]


@pytest.mark.parametrize("limit", [0, 1, 3, 40, 41, 1000])
def test_most_frequent_values_as_sorted(spark, limit, capsys):
    rnd = random.Random(8)
    values = [f"v{min(rnd.randrange(60), rnd.randrange(60)):02d}" for _ in range(700)] + [f"once{i}" for i in range(50)] + [None] * 9
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    counts = {}
    for v in values:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    expected = sorted(((v, n) for v, n in counts.items()), key=lambda x: (-x[1], x[0]))[:limit]
    assert [tuple(r) for r in profile.top_values(df, "a.b", limit).collect()] == expected
