"""Exact quantiles and equal-width histograms that need no task to hold all values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.functions.names import named

# Rank error of the first, approximate look is 1/ACCURACY.
ACCURACY = 10_000
SLICES = 1000
_MOST = 1.7976931348623157e308


def _number(value: Column) -> Column:
    """The value as a double, NaN as null. Nulls stay: aggregates ignore them for free."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def _numbers(df: DataFrame, value: str) -> DataFrame:
    return df.select(_number(named(value)).alias("x"))


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = ACCURACY, moments: bool = False
) -> DataFrame:
    """(column_name, count, least, most, q): exact quantiles of all ``columns`` in two reads, however many there are.

    ``q`` is an array with one number per probability, linearly interpolated. ``probabilities`` must ascend; 0 and 1 are
    the least and the greatest value. Infinite values take part: a result between two values of which one is infinite is
    infinite, between both infinities NaN. ``moments`` adds mean and std (of the sample) from the first read.

    Spark's exact ``percentile`` keeps every distinct value of a column in one task. Here one approximate look at all
    columns brackets each wanted rank. In the second read every cell is a row (column, value): values between brackets are
    merely counted, before anything is shuffled, and only the values inside, about 8/accuracy of a column per probability,
    are ordered. Raises if a rank falls outside its bracket, so a result is always exact.
    """
    names, every = list(columns), list(probabilities)
    probabilities = [p for p in every if 0 < p < 1]
    k = len(probabilities)
    spread = 4.0 / accuracy
    ends = [max(p - spread, 0.0) for p in probabilities] + [min(p + spread, 1.0) for p in probabilities]
    numbers = df.select(*[_number(named(c)).alias(f"x{i}") for i, c in enumerate(names)])

    def seen(i: int) -> Column:
        x = F.col(f"x{i}")
        parts = [F.count(x).alias("n"), F.min(x).alias("least"), F.max(x).alias("most")]
        if k:
            parts.append(F.percentile_approx(x, ends, accuracy).alias("ends"))
        if moments:
            parts += [F.avg(x).alias("mean"), F.stddev_samp(x).alias("std")]
        return F.struct(F.lit(names[i]).alias("column_name"), *parts)

    look = numbers.agg(F.array(*[seen(i) for i in range(len(names))]).alias("all"))
    plain = ["column_name", "n as count", "least", "most", *(["mean", "std"] if moments else [])]
    if not k:
        q = ", ".join("least" if p <= 0 else "most" for p in every)
        return look.selectExpr("inline(all)").selectExpr(*plain, f"array({q}) as q")
    # On few rows the bracket is the whole range; beyond, it is wide enough for rank errors.
    few = f"s.n <= {accuracy}"
    low = [f"if({few} or {p <= spread}, s.least, s.ends[{i}])" for i, p in enumerate(probabilities)]
    high = [f"if({few} or {p >= 1 - spread}, s.most, s.ends[{k + i}])" for i, p in enumerate(probabilities)]
    bracket = f"struct(s.n as n, array({', '.join(low)}) as low, array({', '.join(high)}) as high)"
    edges = look.selectExpr(f"transform(all, s -> {bracket})").scalar()

    if len(names) == 1:
        cells = numbers.select(F.lit(0).alias("c"), F.col("x0").alias("x"))
    else:
        each = [F.struct(F.lit(i).alias("c"), F.col(f"x{i}").alias("x")) for i in range(len(names))]
        cells = numbers.select(F.inline(F.array(*each)))
    # Bracket b of a value: how many brackets end below it. Null inside group = before bracket b.
    passed = " + ".join(f"int(x > e.high[{i}])" for i in range(k))
    counted = (
        cells.where("x is not null")
        .withColumn("e", F.get(edges, F.col("c")))
        .selectExpr("c", "x", "e", f"{passed} as b")
        .selectExpr("c", "b", "if(x >= get(e.low, b), x, null) as x")
        .groupBy("c", "b", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Each bracket is cut into SLICES ranges that are ordered apart; values before it are slice -1.
    # Halves of values cut to the finite range: no difference overflows, and the order of slices stays.
    half = lambda v: f"(least(greatest({v}, -{_MOST}D), {_MOST}D) / 2)"
    low, high = half("get(e.low, b)"), half("get(e.high, b)")
    reach = f"try_divide({half('x')} - {low}, {high} - {low})"
    sliced = counted.withColumn("e", F.get(edges, F.col("c"))).selectExpr(
        "c", "b", "x", "n", "e.n as rows", f"if(x is null, -1, coalesce(int({reach} * {SLICES}), 0)) as s"
    )
    # At most SLICES + 2 rows per column and probability.
    before = (
        sliced.groupBy("c", "b", "s")
        .agg(F.sum("n").alias("own"))
        .withColumn("before", F.sum("own").over(Window.partitionBy("c").orderBy("b", "s")) - F.col("own"))
        .drop("own")
    )
    if len(names) * k <= 32:
        before = F.broadcast(before)
    rising = Window.partitionBy("c", "b", "s").orderBy("x")
    placed = sliced.join(before, ["c", "b", "s"]).withColumn("upto", F.col("before") + F.sum("n").over(rising))
    found, answers = [], []
    for i, p in enumerate(probabilities):
        rank = f"(double({float(p)!r}) * (rows - 1))"
        found += [
            f"min(if(x is not null and upto > floor({rank}), x, null)) as a{i}",
            f"min(if(x is not null and upto > ceil({rank}), x, null)) as b{i}",
            f"bool_or(x is null and upto > floor({rank}) and upto - n <= ceil({rank})) as missed{i}",
            f"max({rank}) as r{i}",
        ]
        answers.append(
            f"if(r{i} is not null and (missed{i} or a{i} is null or b{i} is null), "
            f"double(raise_error('a quantile fell outside its bracket')), "
            f"if(a{i} = b{i} or r{i} = floor(r{i}), a{i}, a{i} + (b{i} - a{i}) * (r{i} - floor(r{i}))))"
        )
    done = placed.groupBy("c").agg(*[F.expr(e) for e in found]).selectExpr("c", f"array({', '.join(answers)}) as inner")
    inner = iter(range(k))
    q = ", ".join(("least" if p <= 0 else "most") if not 0 < p < 1 else f"inner[{next(inner)}]" for p in every)
    shown = look.selectExpr("posexplode(all) as (c, s)").selectExpr("c", "s.*")
    return shown.join(done, "c", "left").selectExpr(*plain, f"array({q}) as q")


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row with a column ``q0``, ``q1``, … per probability: ``column_quantiles`` of one column."""
    found = column_quantiles(df, [value], probabilities, accuracy)
    return found.select(*[F.col("q")[i].alias(f"q{i}") for i in range(len(probabilities))])


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins from least to greatest value; the last bin is closed.

    Empty bins are present with 0. Equal extremes widen to half a unit on each side. Bins are over the finite values;
    infinite ones, if there are any, are counted in a bin -1 below and a bin ``bins`` above.
    """
    everything = _numbers(df, value)
    infinite = F.abs("x") == float("inf")
    numbers = everything.where(~infinite)
    flat = F.min("x") == F.max("x")
    ends = numbers.agg(
        F.struct(
            F.when(flat, F.min("x") - 0.5).otherwise(F.min("x")).alias("low"),
            F.when(flat, F.max("x") + 0.5).otherwise(F.max("x")).alias("high"),
        )
    ).scalar()
    step = (F.col("e.high") - F.col("e.low")) / bins
    edge = lambda i: F.col("e.low") + i * step
    guess = F.least(
        F.floor((F.col("x") - F.col("e.low")) / (F.col("e.high") - F.col("e.low")) * bins), F.lit(bins - 1)
    )
    # The division may land next to the right bin; the edges decide.
    shift = (
        F.when(F.col("x") < edge(F.col("g")), -1)
        .when((F.col("x") >= edge(F.col("g") + 1)) & (F.col("g") < bins - 1), 1)
        .otherwise(0)
    )
    counted = (
        numbers.where("x is not null")
        .withColumn("e", ends)
        .withColumn("g", guess)
        .select((F.col("g") + shift).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    beyond = (
        everything.where(infinite)
        .groupBy(F.when(F.col("x") < 0, -1).otherwise(bins).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("e", ends)
        .select(
            "bin",
            F.when(F.col("bin") < 0, float("-inf")).otherwise(F.col("e.high")).alias("low"),
            F.when(F.col("bin") < 0, F.col("e.low")).otherwise(float("inf")).alias("high"),
            "count",
        )
    )
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("e", ends)
    return (
        every.join(counted, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("low"),
            F.when(F.col("bin") == bins - 1, F.col("e.high")).otherwise(edge(F.col("bin") + 1)).alias("high"),
            F.coalesce("_n", F.lit(0)).alias("count"),
        )
        .unionByName(beyond)
    )
