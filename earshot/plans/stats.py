"""Per-track statistics and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import quality as Q
from earshot.functions.text import shown, present
from earshot.functions.times import month_of
from earshot.schemas import (
    FULL_LISTEN,
    MIN_PLAYS_FOR_SKIP_REPORT,
    NATURAL_END,
    PARTIAL,
    REPORT_ROWS,
    SKIP,
)

URI = "spotify_track_uri"


def _with_uri(plays: DataFrame) -> DataFrame:
    return plays.where(present(F.col(URI)))


def monthly_plays(plays: DataFrame) -> DataFrame:
    """Plays per track and month."""
    return (
        _with_uri(plays)
        .groupBy(URI, month_of(F.col("played_at")).alias("month"))
        .agg(F.count("*").alias("monthly_plays"))
    )


def _rank_code(plays: Column, month: Column) -> Column:
    """Count and month in one number that sorts by count, then month.

    A number has a fixed width, so its maximum stays in the hash aggregate; the maximum of
    a struct with a text would fall back to a sort.
    """
    return plays * 1_000_000 + F.replace(month, F.lit("-")).cast("bigint")


def _rank_month(code: Column) -> Column:
    digits = F.lpad((code % 1_000_000).cast("string"), 6, "0")
    return F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2))


def _rank_plays(code: Column) -> Column:
    return F.call_function("div", code, F.lit(1_000_000))


def peak_months(plays: DataFrame) -> DataFrame:
    """Per track the month with the most plays, the latest of equals."""
    code = F.max(_rank_code(F.col("monthly_plays"), F.col("month"))).alias("_best")
    return (
        monthly_plays(plays)
        .groupBy(URI)
        .agg(code)
        .select(
            URI,
            _rank_month(F.col("_best")).alias("month"),
            _rank_plays(F.col("_best")).alias("monthly_plays"),
        )
    )


def peak_months_ranked(plays: DataFrame) -> DataFrame:
    """The same by window rank."""
    order = Window.partitionBy(URI).orderBy(F.desc("monthly_plays"), F.desc("month"))
    ranked = monthly_plays(plays).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") == 1).drop("rank")


def track_stats(plays: DataFrame, track_data: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row of statistics per track.

    Rolls up in three steps, days to months to tracks. The first aggregation folds plays by
    track *and* day, so a track with a third of all plays spreads over its days; after it a
    track has at most one row per day. Those rows move to their track once, and both
    further steps run on that partitioning. Names are joined to the finished rows.
    """
    return stats_of_days(track_days(plays), track_data, as_of)


def track_days(plays: DataFrame) -> DataFrame:
    """The sums of each track and day, from which any longer time is folded."""
    quality = F.col("play_quality")
    return (
        _with_uri(plays)
        .groupBy(URI, F.to_date("played_at").alias("day"))
        .agg(
            F.count("*").alias("plays"),
            F.count_if(quality == FULL_LISTEN).alias("full"),
            F.count_if(quality == NATURAL_END).alias("natural"),
            F.count_if(quality == PARTIAL).alias("partial"),
            F.count_if(quality == SKIP).alias("skip"),
            F.count_if(quality.isNull()).alias("none"),
            F.sum("play_percentage").alias("share_sum"),
            F.count("play_percentage").alias("share_n"),
            F.sum("ms_played").alias("ms"),
            F.min("played_at").alias("first"),
            F.max("played_at").alias("last"),
        )
    )


def stats_of_days(days: DataFrame, track_data: DataFrame, as_of: Column | None = None) -> DataFrame:
    """``track_stats`` folded from the sums of ``track_days``."""
    as_of = F.current_date() if as_of is None else as_of
    days = days.repartition(URI)
    added = ["plays", "full", "natural", "partial", "skip", "none", "share_sum", "share_n", "ms"]

    def roll_up(df: DataFrame, *keys: str | Column, extra: tuple[Column, ...]) -> DataFrame:
        return df.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in added],
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            *extra,
        )

    month = month_of(F.col("day"))
    months = roll_up(days, URI, month.alias("month"), extra=(F.count("*").alias("days"),))
    best = F.max(_rank_code(F.col("plays"), F.col("month"))).alias("best")
    tracks = roll_up(months, URI, extra=(F.sum("days").alias("days"), best))

    names = track_data.select(
        F.col("source_uri").alias(URI), "track_name", _first_artist(track_data).alias("artist_name")
    )
    decisive = F.col("full") + F.col("skip") + F.col("partial")
    mean_share = F.try_divide(
        F.col("share_sum").cast("decimal(18,4)"), F.col("share_n").cast("decimal(12,0)")
    )
    minutes = F.col("ms").cast("decimal(20,0)") / F.lit(60000).cast("decimal(5,0)")
    return tracks.join(names, URI, "left").select(
        URI,
        "track_name",
        "artist_name",
        F.col("plays").alias("play_count"),
        F.col("days").alias("unique_days_played"),
        F.col("full").alias("full_listen_count"),
        F.col("natural").alias("natural_end_count"),
        F.col("partial").alias("partial_count"),
        F.col("skip").alias("skip_count"),
        F.col("none").alias("unclassified_count"),
        mean_share.cast("decimal(5,4)").alias("avg_play_percentage"),
        F.col("ms").alias("total_ms_played"),
        minutes.cast("decimal(12,2)").alias("total_minutes_played"),
        Q.share(F.col("skip"), decisive).alias("skip_rate"),
        Q.share(F.col("full"), decisive).alias("completion_rate"),
        F.col("first").alias("first_played_at"),
        F.col("last").alias("last_played_at"),
        F.datediff(as_of, F.to_date("last")).alias("days_since_last"),
        _rank_month(F.col("best")).alias("peak_listen_month"),
        _rank_plays(F.col("best")).alias("peak_month_play_count"),
    )


def _first_artist(track_data: DataFrame) -> Column:
    if "artist_1_name" in track_data.columns:
        return F.col("artist_1_name")
    return F.get("artists", F.lit(0))["name"]


def stats_summary(stats: DataFrame) -> DataFrame:
    """Totals and unweighted means over tracks; tracks without a rate do not count in it."""

    def mean(column: str, digits: int) -> Column:
        total = F.sum(F.col(column).cast("decimal(18,4)"))
        return F.round(F.try_divide(total, F.count(column)), digits).cast(f"decimal(18,{digits})")

    return stats.agg(
        F.count("*").alias("unique_tracks"),
        F.sum("play_count").alias("total_plays"),
        mean("play_count", 2).alias("avg_plays_per_track"),
        F.max("play_count").alias("max_plays_for_one_track"),
        mean("skip_rate", 4).alias("avg_skip_rate"),
        mean("completion_rate", 4).alias("avg_completion_rate"),
    )


def top_played(stats: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The most played tracks; equal counts in URI order."""
    return (
        stats.orderBy(F.desc("play_count"), URI)
        .limit(rows)
        .select(
            URI,
            shown(F.col("track_name")).alias("track_name"),
            shown(F.col("artist_name")).alias("artist_name"),
            "play_count",
            "full_listen_count",
            "skip_count",
            F.round("completion_rate", 3).alias("completion_rate"),
        )
    )


def most_skipped(
    stats: DataFrame, rows: int = REPORT_ROWS, min_plays: int = MIN_PLAYS_FOR_SKIP_REPORT
) -> DataFrame:
    """Tracks with the highest skip rate among those played often enough."""
    return (
        stats.where(F.col("play_count") >= min_plays)
        .withColumn("skip_rate", F.round("skip_rate", 3))
        .orderBy(F.desc("skip_rate"), F.desc("skip_count"), URI)
        .limit(rows)
        .select(
            URI,
            shown(F.col("track_name")).alias("track_name"),
            shown(F.col("artist_name")).alias("artist_name"),
            "play_count",
            "skip_count",
            "skip_rate",
        )
    )
