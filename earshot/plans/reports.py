"""Listening patterns: by time, by month, by raw attribute, and unusual days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import quality as Q
from earshot.functions.text import present
from earshot.functions.times import month_of
from earshot.schemas import FULL_LISTEN, PARTIAL, REPORT_ROWS, SKIP

URI = "spotify_track_uri"


def _counts() -> list[Column]:
    quality = F.col("play_quality")
    return [
        F.count("*").alias("play_count"),
        F.count_if(quality == SKIP).alias("skip_count"),
        F.count_if(quality.isin(FULL_LISTEN, SKIP, PARTIAL)).alias("decisive_count"),
    ]


def _with_skip_rate(df: DataFrame) -> DataFrame:
    rate = Q.share(F.col("skip_count"), F.col("decisive_count")).alias("skip_rate")
    return df.select("*", rate).drop("decisive_count")


def by_hour_and_weekday(plays: DataFrame) -> DataFrame:
    """Plays, skips and skip rate per weekday (0 = Monday) and hour of the local clock."""
    slots = plays.groupBy(
        F.weekday("played_at").alias("weekday"), F.hour("played_at").alias("hour")
    )
    return _with_skip_rate(slots.agg(*_counts()))


def _monthly_tracks(plays: DataFrame) -> DataFrame:
    months = plays.where(present(F.col(URI))).groupBy(
        month_of(F.col("played_at")).alias("month"), URI
    )
    return _with_skip_rate(months.agg(*_counts()))


def _top_of_month(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """The first ``rows`` tracks of each month.

    The rank filter is pushed below the shuffle, each task passes on ``rows`` per month.
    """
    rank = F.row_number().over(Window.partitionBy("month").orderBy(*order, URI))
    return df.withColumn("rank", rank).where(F.col("rank") <= rows)


def monthly_most_played(plays: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    return _top_of_month(_monthly_tracks(plays), rows, F.desc("play_count"))


def monthly_most_skipped(
    plays: DataFrame, rows: int = REPORT_ROWS, min_plays: int = 1
) -> DataFrame:
    """Removal candidates: the highest skip rates of each month."""
    tracks = _monthly_tracks(plays).where(
        (F.col("play_count") >= min_plays) & (F.col("skip_count") > 0)
    )
    return _top_of_month(tracks, rows, F.desc("skip_rate"), F.desc("skip_count"))


def breakdown(history: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and milliseconds of the raw history per value of some of its columns."""
    return history.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum("ms_played").alias("total_ms_played")
    )


def daily_anomalies(plays: DataFrame, window: int = 7, limit: float = 2.0) -> DataFrame:
    """Plays per day against the days with plays before it.

    ``z_score`` compares with mean and sample deviation of up to ``window`` earlier days,
    NULL while there are fewer than two or all are equal. The window runs over one row per
    day. Moments come from whole-number sums, so the result does not depend on row order.
    """
    daily = plays.groupBy(F.to_date("played_at").alias("day")).agg(F.count("*").alias("n"))
    before = Window.orderBy("day").rowsBetween(-window, -1)
    n, total, squares = F.col("_k"), F.col("_sum"), F.col("_squares")
    spread = (n * squares - total * total) / (n * (n - 1))
    mean = total / n
    score = F.when((n > 1) & (n * squares > total * total), (F.col("n") - mean) / F.sqrt(spread))
    return (
        daily.withColumn("_k", F.count("n").over(before))
        .withColumn("_sum", F.sum("n").over(before))
        .withColumn("_squares", F.sum(F.col("n") * F.col("n")).over(before))
        .select("day", F.col("n").alias("play_count"), F.round(score, 6).alias("z_score"))
        .withColumn("unusual", F.abs("z_score") >= limit)
    )
