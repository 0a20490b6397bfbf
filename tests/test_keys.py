"""Key operators against plain windows, with a third of all rows on one key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from limpid.operators import keys, pairs
from limpid.plans.cleaning import clean_records

KEYS = ["a", "b"]


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        if i % 3 == 0:
            rows.append((i * 977, "hot", "hot"))
        elif i % 7 == 0:
            rows.append((i * 977, None, rnd.choice([None, "x"])))
        else:
            rows.append((i * 977, f"k{rnd.randrange(900)}", rnd.choice("xyz")))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "line_no long, a string, b string").repartition(8).cache()


def _same(left, right):
    names = sorted(left.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert names == sorted(right.columns)
    assert sorted(map(tuple, left.select(names).collect()), key=key) == sorted(
        map(tuple, right.select(names).collect()), key=key
    )


@pytest.mark.parametrize("parts", [2, 8, 4096])
def test_row_number(skewed, parts):
    over = Window.partitionBy(*KEYS).orderBy("line_no")
    plain = skewed.withColumn("row_number", F.row_number().over(over))
    _same(keys.with_row_number(skewed, KEYS, "line_no", parts=parts, block=1000), plain)


@pytest.mark.parametrize("parts", [2, 8, 4096])
def test_flags_and_aggregates(skewed, parts):
    over = Window.partitionBy(*KEYS)
    first = Window.partitionBy(*KEYS).orderBy("line_no")
    _same(keys.flag_shared_key(skewed, KEYS, "f", parts), skewed.withColumn("f", F.count("*").over(over) > 1))
    _same(
        keys.flag_later_copies(skewed, KEYS, "line_no", "f", parts),
        skewed.withColumn("f", F.row_number().over(first) > 1),
    )
    members = skewed.where("line_no % 2 = 0").select(*KEYS).distinct()
    _same(
        keys.flag_members(skewed, members, KEYS, "f", parts),
        skewed.withColumn("f", F.max(F.col("line_no") % 2 == 0).over(over)),
    )


def test_heavy_keys_are_few_and_found(spark, skewed):
    hot = skewed.where("a = 'hot'").select(F.xxhash64(*KEYS)).first()[0]
    assert keys.heavy_hashes(skewed, KEYS, 8) == [hot]
    assert hot in keys.heavy_hashes(skewed, KEYS, 4096)
    # Every key above the bound is found among many light ones, and none far below it.
    many = spark.range(400_000).selectExpr("if(id % 50 = 0, 1, if(id % 100 = 1, 2, if(id % 400 = 3, 3, id))) as k").repartition(16)
    expected = [r.h for r in many.groupBy("k").count().where("count > 400000 / 256").select(F.xxhash64("k").alias("h")).collect()]
    assert sorted(keys.heavy_hashes(many, ["k"], 256)) == sorted(expected) and len(expected) == 2
    assert keys.heavy_hashes(many.limit(0), ["k"], 256) == []
    assert keys.heavy_hashes(spark.range(400_000), ["id"], 256) == []


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_one_read_and_one_shuffle(spark, tmp_path, skewed, capsys):
    """Without heavy keys the table is scanned and shuffled once; with them rows go by key and salt, or key and block."""
    skewed.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    even = df.where("a != 'hot'")
    members = spark.createDataFrame([("k1", "x")], "a string, b string")
    wide = "ReadSchema: struct<line_no:bigint,a:string,b:string>"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for make, part in (
            (lambda t, p: keys.flag_shared_key(t, KEYS, "f", p), "_salt"),
            (lambda t, p: keys.flag_members(t, members, KEYS, "f", p), "_salt"),
            (lambda t, p: keys.with_row_number(t, KEYS, "line_no", parts=p, block=500), "_block"),
        ):
            plan = _plan(make(even, 2), capsys)
            assert plan.count("FileScan") == 1 and plan.count("Exchange") - plan.count("ExistingRDD") == 1
            plan = _plan(make(df, 8), capsys)
            assert any(part in line for line in plan.splitlines() if "Exchange hashpartitioning(" in line)
            if part == "_salt":
                assert plan.count(wide) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_heavy_key_is_dealt_over_many_groups(skewed):
    spread = skewed.where("a = 'hot'").select(keys._spread(skewed).alias("s")).groupBy("s").count()
    assert spread.count() > 500 and spread.agg(F.max("count")).first()[0] < 20


def test_copies_in_many_tasks_are_dealt_too(spark):
    df = spark.range(20_000, numPartitions=40).select(F.lit("x").alias("k"))
    assert df.select(keys._spread(df).alias("s")).distinct().count() == 40
    assert keys.with_key_aggregates(df, ["k"], {"n": F.count(F.lit(1))}).where("n = 20000").count() == 20_000


def test_names_with_signs(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "x", 6), (3, None, 7), (4, None, 8), (5, "y", 9)], "`line.no` int, `a.b` string, `c``d` int")
    for parts in (2, 4096):
        flagged = keys.flag_shared_key(df, ["a.b"], "shared.key", parts)
        assert {r[0]: r[3] for r in flagged.collect()} == {1: True, 2: True, 3: True, 4: True, 5: False}
        later = keys.flag_later_copies(df, ["a.b"], "line.no", "copy", parts)
        assert {r[0] for r in later.where("copy").collect()} == {2, 4}
        numbered = keys.with_row_number(df, ["a.b"], "line.no", "n", parts, block=1)
        assert {r[0]: r.n for r in numbered.collect()} == {1: 1, 2: 2, 3: 1, 4: 2, 5: 1}
        member = keys.flag_members(df, df.where("`a.b` is null").select("`a.b`").distinct(), ["a.b"], "m", parts)
        assert {r[0] for r in member.where("m").collect()} == {3, 4}
    assert keys.keep_first(df, ["a.b"], "line.no").count() == 3
    assert keys.count_copies(df, ["a.b", "c`d"]).first().copies == 0


def test_keep_first(skewed):
    over = Window.partitionBy(*KEYS).orderBy("line_no")
    plain = skewed.withColumn("n", F.row_number().over(over)).where("n = 1").drop("n")
    _same(keys.keep_first(skewed, KEYS, "line_no"), plain)


def test_keep_first_limits_each_key_before_the_shuffle(skewed, capsys):
    keys.keep_first(skewed, KEYS, "line_no").explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0 and "Partial" in plan


def test_cleaning_shuffles_once(records, capsys):
    clean_records(records([("2015", "1", "MATH1001", "9", "V", "1")])).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_count_copies(skewed):
    row = keys.count_copies(skewed, KEYS).first()
    assert row.rows == 6000 and row.distinct_keys == skewed.select(*KEYS).distinct().count()
    assert row.copies == row.rows - row.distinct_keys


def test_pair_rule_three_ways(records):
    df = records(
        [
            ("2015", "1", "A", "9", "V", "1"),
            ("2015", "1", "A", "9", "V", "2"),
            ("2015", "2", "A", "9", "V", "2"),
            ("2015", "2", "A", "9", "V", "x"),
            ("2015", None, "A", "9", "V", "2.0"),
            ("2015", None, None, "9", "V", "1.0"),
            ("2015", None, None, "9", "V", "2"),
            ("2015", "3", "A", "9", "V", "1.7"),
            ("2015", "3", "A", "9", "V", "2"),
        ]
    )
    lonely = pairs.pairs_without_first(df)
    assert {tuple(r) for r in lonely.collect()} == {("2", "A"), (None, "A"), ("3", "A")}
    marked = pairs.mark_pairs(df, lonely, "bad")
    _same(marked, pairs.flag_second_without_first(df, "bad"))
    assert {r.line_no for r in marked.where("bad").collect()} == {2, 3, 4, 7, 8}


def test_row_numbers_of_a_hot_key_with_sparse_order(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), (F.col("id") * 10_000_000 + 2**54).alias("o"))
    from limpid.operators import keys

    got = keys.with_row_number(df, ["k"], "o", block=100)
    assert [r.row_number for r in got.orderBy("o").collect()] == list(range(1, 3001))
