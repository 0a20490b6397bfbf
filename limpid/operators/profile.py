"""Column and table profiles: missing values, frequencies, duplicates, correlations.

Everything per value is a count per (column, value), combined map-side, so a
table of any size reduces to its distinct values before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.names import named, nan_as_null
from limpid.operators.keys import count_copies
from limpid.operators.quantiles import column_quantiles
from limpid.rules import DEFAULT, Rules
from limpid.sources.shared import stored_table

def _rows() -> Column:
    return F.count(F.lit(1))


def count_rows(df: DataFrame) -> DataFrame:
    """One row with ``rows``; Parquet tables give it from their footers."""
    return df.agg(_rows().alias("rows"))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, rows, missing) per column, from one pass without a shuffle of rows; NaN is missing."""
    columns = list(columns or df.columns)
    seen = nan_as_null(df.select(*[named(c) for c in columns]))
    wide = seen.agg(_rows().alias("_rows"), *[F.count_if(named(c).isNull()).alias(f"_m{i}") for i, c in enumerate(columns)])
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*cells)))


def missing_total(df: DataFrame) -> DataFrame:
    return missing_counts(df).agg(F.sum("missing").alias("missing_cells"))


def missing_rates(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Missing share per column; ``digits`` rounds the share before it becomes a percentage."""
    share = F.try_divide(F.col("missing").cast("double"), F.col("rows"))
    shown = share if digits is None else F.bround(share, digits)
    return missing_counts(df).select("column_name", (shown * 100).alias("missing_pct"))


def missing_rank(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Columns with missing values, worst first; at most ``limit`` if one is given."""
    ranked = missing_rates(df).where("missing_pct > 0").orderBy(F.desc("missing_pct"), "column_name")
    return ranked if limit is None else ranked.limit(limit)


def table_info(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null) per column."""
    kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return missing_counts(df).select(
        "column_name",
        F.element_at(kinds, F.col("column_name")).alias("data_type"),
        (F.col("rows") - F.col("missing")).alias("non_null"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows equal to an earlier row on every column."""
    return count_copies(df, df.columns).select(F.col("copies").alias("duplicate_rows"))


def duplicate_texts(df: DataFrame, text: str) -> DataFrame:
    """As ``duplicate_rows`` for one column of long text, moving a SHA-256 instead of the text."""
    return count_copies(df.select(F.sha2(text, 256).alias("_h"), F.length(text).alias("_l")), ["_h", "_l"]).select(
        F.col("copies").alias("duplicate_rows")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count, share) of the non-null values."""
    counts = df.where(named(column).isNotNull()).groupBy(named(column).alias("value")).agg(_rows().alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def top_values(df: DataFrame, column: str, limit: int) -> DataFrame:
    """The ``limit`` most frequent values; equal counts in value order.

    How many values have each count tells the least count that is needed; only values that reach it are ordered. The counts
    per value are made once: both uses read one exchange.
    """
    counts = df.where(named(column).isNotNull()).groupBy(named(column).alias("value")).agg(_rows().alias("count"))
    # Distinct counts are few: n of them need n * n / 2 rows.
    reach = counts.groupBy("count").agg(_rows().alias("n")).withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("count"))))
    least = reach.where(F.col("upto") >= limit).agg(F.coalesce(F.max("count"), F.lit(0))).scalar()
    return counts.where(F.col("count") >= least).orderBy(F.desc("count"), "value").limit(limit)


def shown_values(df: DataFrame, column: str, limit: int) -> DataFrame:
    """``top_values`` of any column. Whether ``describe_numeric`` says more of a number is the caller's choice."""
    return top_values(df, column, limit)


# Values of up to so many bytes are counted as they are, longer ones by a digest of 128 bits.
SHORT = 32
# So many candidates for the smallest of equally frequent long values are fetched at once.
FETCHED = 10_000


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(c, num, value) per cell; c is the column's place, ``num`` orders the values of numeric columns."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    cells = [
        F.struct(
            F.lit(i).alias("c"),
            (named(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("num"),
            named(c).cast("string").alias("value"),
        )
        for i, c in enumerate(columns)
    ]
    return df.select(F.inline(F.array(*cells)))


def _keyed(cells: DataFrame) -> DataFrame:
    """(c, num, short, digest, value): numbers and short values are their own key, of others the digest is."""
    long = F.col("num").isNull() & (F.octet_length("value") > SHORT)
    return cells.select(
        "c", "num", F.when(~long, F.col("value")).alias("short"), F.when(long, F.unhex(F.md5("value"))).alias("digest"), "value"
    )


def _least_text(keyed: DataFrame, winners: DataFrame, fetched: int) -> DataFrame:
    """(c, text): the smallest text of each column among the winners (c, digest).

    A few of them, those with the least digests, are fetched: the least of their texts on each task, so no more texts than
    that are shuffled. If a column has more winners, those with a smaller text are winners of the next round; as the ones
    fetched are as good as drawn at random, a round leaves about 1/fetched of them.
    """
    known = None
    while True:
        first = Window.partitionBy("c").orderBy("digest")
        some = winners.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= fetched).drop("_n")
        texts = keyed.join(F.broadcast(some), ["c", "digest"]).groupBy("c").agg(F.min("value").alias("text"))
        known = texts if known is None else known.unionByName(texts)
        more = winners.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > fetched).collect()  # a row a column at most
        if not more:
            return known.groupBy("c").agg(F.min("text").alias("text"))
        bound = {r["c"]: r["text"] for r in texts.where(F.col("c").isin([r["c"] for r in more])).collect()}
        below = F.lit(False)
        for c, text in bound.items():
            below = below | ((F.col("c") == c) & (F.col("value") < text))
        smaller = keyed.where(F.col("digest").isNotNull() & below).select("c", "digest").distinct()
        winners = stored_table(winners.join(smaller, ["c", "digest"], "left_semi"), "winners")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, fetched: int = FETCHED) -> DataFrame:
    """(column_name, data_type, distinct_count, missing, missing_pct, top_value, top_count).

    The top value is the most frequent one, the smallest of those in a tie: by number, then by text.

    One read counts the cells of all columns. Long values are counted by digest, so none is shuffled; the counts are written
    to the shared folder. Only if a column's most frequent values are long ones, their text is looked up in a second read.
    """
    return _profiled(df, list(columns or df.columns), fetched).drop("rows")


def _profiled(df: DataFrame, columns: Sequence[str], fetched: int = FETCHED) -> DataFrame:
    """``column_profile`` with the number of ``rows``."""
    kinds = dict(df.dtypes)
    cells = _cells(nan_as_null(df.select(*[named(c) for c in columns])), columns)
    keyed = _keyed(cells)
    counts = stored_table(keyed.groupBy("c", "num", "short", "digest").agg(_rows().alias("n")), "counts")
    present = F.col("short").isNotNull() | F.col("digest").isNotNull()
    per_column = counts.groupBy("c").agg(
        F.count_if(present).alias("distinct_count"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("missing"),
        F.sum("n").alias("rows"),
        F.max(F.when(present, F.col("n"))).alias("top_count"),
    )
    top = per_column.select("c", "top_count")
    winners = counts.where(present).join(F.broadcast(top), "c").where("n = top_count")
    best = winners.groupBy("c").agg(
        F.min(F.when(F.col("short").isNotNull(), F.struct("num", F.col("short").alias("value")))).alias("best"),
        F.count("digest").alias("long"),
    )
    found = per_column.join(best, "c", "left")
    long = {r["c"]: r["top_count"] for r in found.where("long > 0").select("c", "top_count").collect()}  # a row a column at most
    # Where no value comes twice, every value is a winner: the smallest is a plain minimum.
    alone = [c for c, n in long.items() if n == 1]
    tied = [c for c, n in long.items() if n > 1]
    texts = None
    if alone:
        texts = keyed.where(F.col("c").isin(alone) & F.col("digest").isNotNull()).groupBy("c").agg(F.min("value").alias("text"))
    if tied:
        some = winners.where(F.col("c").isin(tied) & F.col("digest").isNotNull()).select("c", "digest")
        rest = _least_text(keyed, some, max(1, fetched // len(tied)))
        texts = rest if texts is None else texts.unionByName(rest)
    value = F.col("best.value")
    if texts is not None:
        found = found.join(texts, "c", "left")
        value = F.when(value.isNull() | (F.col("text") < value), F.col("text")).otherwise(value)
    names = F.array(*[F.lit(c) for c in columns])
    types = F.array(*[F.lit(kinds[c]) for c in columns])
    return found.select(
        F.get(names, F.col("c")).alias("column_name"),
        F.get(types, F.col("c")).alias("data_type"),
        "distinct_count",
        "missing",
        (F.lit(100.0) * F.col("missing") / F.col("rows")).alias("missing_pct"),
        value.alias("top_value"),
        "top_count",
        "rows",
    )


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, std, min, 25 %, 50 %, 75 %, max, with exact quartiles."""
    return _described(df, [column]).drop("column_name")


def _described(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The numbers of ``describe_numeric`` for each of the columns, in two reads."""
    found = column_quantiles(df, columns, [0.25, 0.5, 0.75], moments=True)
    return found.select(
        "column_name", "count", "mean", "std", F.col("least").alias("min"),
        *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))], F.col("most").alias("max"),
    )


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: count; unique, top, freq for text; the numbers of A36 for numeric columns.

    Two reads for all numeric columns and those of ``column_profile`` for all others.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [c for c in df.columns if c not in numeric]
    layout = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    nothing = lambda kind: F.lit(None).cast(kind)
    parts = []
    if text:
        parts.append(
            _profiled(df, text).select(
                "column_name",
                (F.col("rows") - F.col("missing")).alias("count"),
                F.col("distinct_count").alias("unique"),
                F.col("top_value").alias("top"),
                F.col("top_count").alias("freq"),
                *[nothing("double").alias(c) for c in layout],
            )
        )
    if numeric:
        numbers = _described(df, numeric).select(
            "column_name",
            "count",
            nothing("long").alias("unique"),
            nothing("string").alias("top"),
            nothing("long").alias("freq"),
            *[F.col(n).cast("double").alias(n) for n in layout],
        )
        parts.append(numbers)
    return reduce(DataFrame.unionByName, parts)


def missing_correlation(
    df: DataFrame, exclude: Sequence[str] = ("note_out_of_range", "note_incoherent"), limit: int | None = None
) -> DataFrame:
    """(col_a, col_b, corr): Pearson correlation of "is missing" between columns that have missing values.

    Rows reduce to their pattern of missing cells, counted map-side; pairs of columns are then counted over the few
    distinct patterns. With ``limit`` only the columns with the most missing values take part. NaN is missing.
    """
    columns = [c for c in df.columns if c not in exclude]
    p = len(columns)
    df = nan_as_null(df.select(*[named(c) for c in columns]))
    flags = [F.when(named(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns]
    # A last column that is missing everywhere makes its own count the row count.
    patterns = df.select(F.concat(*flags, F.lit("1")).alias("bits")).groupBy("bits").agg(_rows().alias("n"))
    held = patterns.selectExpr("n", f"filter(sequence(0, {p}), i -> substr(bits, i + 1, 1) = '1') as m")
    own = held.select("n", F.explode_outer("m").alias("a")).groupBy("a").agg(F.sum("n").alias("n"))
    total = own.where(F.col("a") == p).agg(F.sum("n")).scalar()
    own = own.where(F.col("a") < p)
    if limit is not None:
        own = own.orderBy(F.desc("n"), "a").limit(limit)
        chosen = own.agg(F.collect_list("a")).scalar()  # `limit` numbers
        held = held.withColumn("m", F.array_intersect("m", chosen))
    # The lists are rarely empty; a plain explode would test that on every row.
    both = (
        held.select("n", "m", F.explode_outer("m").alias("a"))
        .selectExpr("n", "a", "explode_outer(filter(m, j -> j > a)) as b")
        .where(f"a < {p} and b < {p}")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("joint"))
    )
    pairs = own.selectExpr("a", "n as na", f"explode(sequence(0, {p - 1})) as b").where("a < b").join(own.selectExpr("a as b", "n as nb"), "b")
    # Products of counts pass the range of long integers beyond 3 billion rows.
    n, na, nb = (F.col(c).cast("double") for c in ("total", "na", "nb"))
    joint = F.coalesce("joint", F.lit(0)).cast("double")
    names = F.array(*[F.lit(c) for c in columns])
    return (
        pairs.join(both, ["a", "b"], "left")
        .withColumn("total", total)
        .select(
            F.get(names, F.col("a")).alias("col_a"),
            F.get(names, F.col("b")).alias("col_b"),
            F.try_divide(n * joint - na * nb, F.sqrt(n * na - na * na) * F.sqrt(n * nb - nb * nb)).alias("corr"),
        )
    )


def issue_summary(ragged: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """One row: missing cells, lines with a seventh field, invalid sessions, duplicate rows."""
    columns = [*rules.cols.fields, "EXTRA"]
    frame = ragged.select(*columns)
    session = F.col(rules.cols.session)
    known = F.coalesce(session.isin(*[str(s) for s in rules.sessions]), F.lit(False))
    copies = duplicate_rows(frame).scalar()
    missing = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return frame.agg(
        F.coalesce(F.sum(missing), F.lit(0)).alias("missing_cells"),
        F.count_if(F.col("EXTRA").isNotNull()).alias("extra_field_rows"),
        F.count_if(~known).alias("invalid_sessions"),
    ).withColumn("duplicate_rows", copies)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all if fewer), the same ones every time: the lowest seeded digests.

    Counting rows by the first digest digits, then by the next ones in the range where the n-th row lies, leaves about
    n rows to sort at any table size, and not n per task.
    """
    marked = df.withColumn("_mark", F.md5(F.concat_ws(":", *keys, F.lit(seed))))
    found = _reach(marked, 4, n)
    last, left = found.select("start").scalar(), found.select("left").scalar()
    # "g" is above every digest: fewer than n rows in all.
    within = _reach(marked.where(F.substring("_mark", 1, 4) == last), 8, left)
    bound = F.when(last == "g", last).otherwise(within.select("start").scalar())
    return marked.where(F.substring("_mark", 1, 8) <= bound).orderBy("_mark", *keys).limit(n).drop("_mark")


def _reach(marked: DataFrame, digits: int, n: int | Column) -> DataFrame:
    """(start, left): the digits where the n-th row lies, and which row it is there; at most 65,536 counts."""
    wanted = F.lit(n) if isinstance(n, int) else n
    counts = marked.groupBy(F.substring("_mark", 1, digits).alias("start")).agg(_rows().alias("rows"))
    upto = counts.withColumn("upto", F.sum("rows").over(Window.orderBy("start"))).withColumn("wanted", wanted)
    here = F.struct("start", (F.col("wanted") - F.col("upto") + F.col("rows")).cast("long").alias("left"))
    none = F.struct(F.lit("g").alias("start"), F.lit(0).cast("long").alias("left"))
    return upto.agg(F.coalesce(F.min(F.when(F.col("upto") >= F.col("wanted"), here)), none).alias("f")).select("f.*")
