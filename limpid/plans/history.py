"""Score history over time, and before/after comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.functions.text import percent_text
from limpid.rules import DASHBOARD_ORDER

STAGE, TIME = "stage", "timestamp"


def history_row(scores: DataFrame, stage: str, at: Column) -> DataFrame:
    """Score rows as history rows; ``at`` is the time of scoring."""
    return scores.select(at.alias(TIME), F.lit(stage).alias(STAGE), *scores.columns)


def utc_now() -> Column:
    """The current UTC time without a zone, whatever the session's time zone."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def iso_text(at: Column) -> Column:
    """Time as ISO text to the microsecond."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def with_stage(history: DataFrame) -> DataFrame:
    """Histories written before stages existed count as cleaned."""
    if STAGE not in history.columns:
        return history.withColumn(STAGE, F.lit("cleaned"))
    return history.withColumn(STAGE, F.coalesce(STAGE, F.lit("cleaned")))


def extend(history: DataFrame, rows: DataFrame) -> DataFrame:
    """History plus new rows; columns either side lacks are null."""
    return with_stage(history).unionByName(rows, allowMissingColumns=True)


def by_time(history: DataFrame) -> DataFrame:
    return history.orderBy(TIME, *[c for c in (STAGE,) if c in history.columns])


def of_stage(history: DataFrame, stage: str) -> DataFrame:
    return history.where(F.col(STAGE) == stage)


def latest_per_stage(history: DataFrame) -> DataFrame:
    """The last row of each stage; one row per stage and task reaches the shuffle."""
    last = Window.partitionBy(STAGE).orderBy(F.desc(TIME))
    return history.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def latest_pair(history: DataFrame, before: str = "raw", after: str = "cleaned") -> DataFrame:
    """Latest rows of both stages, or nothing while one of them is missing."""
    latest = latest_per_stage(history.where(F.col(STAGE).isin(before, after)))
    return latest.where(latest.agg(F.count(F.lit(1))).scalar() == 2)


def score_columns(history: DataFrame, order: Sequence[str] = DASHBOARD_ORDER) -> list[str]:
    return [c for c in order if c in history.columns]


def melt_scores(history: DataFrame, ids: Sequence[str] = (TIME, STAGE)) -> DataFrame:
    """(ids…, metric, score), for the metric columns that exist."""
    return history.unpivot(list(ids), score_columns(history), "metric", "score")


def in_display_order(melted: DataFrame, order: Sequence[str] = DASHBOARD_ORDER) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("metric"))
    return melted.withColumn("place", place).orderBy("place", TIME, STAGE)


def score_report(scores: DataFrame, total: str = "global_score", label: str = "Score Global") -> DataFrame:
    """(metric, score, score_pct) from one score row, the global score under ``label``."""
    named = scores.withColumnRenamed(total, label)
    return named.unpivot([], named.columns, "metric", "score").withColumn(
        "score_pct", F.bround(F.col("score") * 100, 1)
    )


def report_by_score(report: DataFrame, label: str = "Score Global") -> DataFrame:
    """The dimensions of a report, weakest first, without the global score."""
    return report.where(F.col("metric") != label).orderBy("score_pct", "metric")


def compare(before: DataFrame, after: DataFrame, shown: bool = False) -> DataFrame:
    """(dimension, before, after, gain) of two score rows; a score missing before counts as 0."""
    dimensions = [c for c in after.columns if c not in ("global_score", "rows")]
    old = [c for c in before.columns if c not in ("global_score", "rows")]
    joined = after.unpivot([], dimensions, "dimension", "after").join(
        before.unpivot([], old, "dimension", "before"), "dimension", "left"
    )
    b = F.coalesce("before", F.lit(0.0))
    gain = F.col("after") - b
    if shown:
        return joined.select(
            "dimension",
            percent_text(b).alias("before"),
            percent_text(F.col("after")).alias("after"),
            percent_text(gain, signed=True).alias("gain"),
        )
    return joined.select("dimension", b.alias("before"), "after", gain.alias("gain"))


def kpi_delta(raw_scores: DataFrame, cleaned_scores: DataFrame) -> DataFrame:
    """One row: rows, global score and distribution after cleaning, each with its change.

    Both are score rows with the number of ``rows``, so no table is read for its rows alone.
    """
    was = raw_scores.select(F.struct("global_score", "Distribution", "rows")).scalar()
    return cleaned_scores.withColumn("was", was).select(
        "rows",
        (F.col("rows") - F.col("was.rows")).alias("rows_delta"),
        "global_score",
        (F.col("global_score") - F.col("was.global_score")).alias("global_delta"),
        F.col("Distribution").alias("distribution"),
        (F.col("Distribution") - F.col("was.Distribution")).alias("distribution_delta"),
    )
