"""From the two raw tables to the unified ``plays`` table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import quality as Q
from earshot.functions.text import present
from earshot.functions.times import instant as to_instant
from earshot.functions.times import local_time
from earshot.operators.overlap import without_overlap
from earshot.operators.timeline import gap_to_next
from earshot.schemas import (
    HOME_TIMEZONE,
    PLAY_COLUMNS,
    SOURCE_HISTORY,
    SOURCE_RECENT,
    Thresholds,
)

URI = "spotify_track_uri"
DEFAULTS = Thresholds()


def durations(track_data: DataFrame) -> DataFrame:
    """The two columns the classification needs; ``source_uri`` must be unique."""
    return track_data.select(F.col("source_uri").alias(URI), "duration_ms")


def credible(history: DataFrame) -> DataFrame:
    """History rows with a URI and at least one signal of a real play.

    The negation keeps SQL's three values: NULL milliseconds without any reason go as well.
    """
    ghost = Q.low_confidence(F.col("ms_played"), F.col("reason_start"), F.col("reason_end"))
    return history.where(present(F.col(URI)) & ~ghost)


def unparsed_history(history: DataFrame) -> DataFrame:
    """Credible history rows whose ``ts`` is no time: the quarantine of ``on_bad="skip"``."""
    return credible(history).where(to_instant(F.col("ts")).isNull())


def history_events(
    history: DataFrame, tz: str = HOME_TIMEZONE, on_bad: str = "fail"
) -> DataFrame:
    """Credible history rows with local ``played_at``.

    An unusable ``ts`` fails the job, as a NOT NULL column would; ``on_bad="skip"`` leaves
    such rows out, ``unparsed_history`` has them.
    """
    instant = to_instant(F.col("ts"))
    rows = credible(history)
    if on_bad == "skip":
        rows = rows.where(instant.isNotNull())
    elif on_bad == "fail":
        message = F.concat(F.lit("unusable ts: "), F.coalesce("ts", F.lit("NULL")))
        instant = F.coalesce(instant, F.raise_error(message).cast("timestamp"))
    else:
        raise ValueError("on_bad is 'fail' or 'skip'")
    return rows.withColumn("played_at", local_time(instant, tz))


def classify_history(
    history: DataFrame,
    track_data: DataFrame,
    limits: Thresholds = DEFAULTS,
    tz: str = HOME_TIMEZONE,
    on_bad: str = "fail",
) -> DataFrame:
    """Plays of the exported history, quality from end reason and played ratio."""
    return classify_events(history_events(history, tz, on_bad), track_data, limits)


def classify_events(events: DataFrame, track_data: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """The same of events whose time is known already."""
    return (
        events.select(URI, "played_at", "ms_played", "reason_end")
        .join(durations(track_data), URI, "left")
        .withColumn("_ratio", Q.history_ratio(F.col("ms_played"), F.col("duration_ms")))
        .withColumn("play_percentage", Q.played_share(F.col("_ratio")))
        .withColumn(
            "play_quality", Q.history_quality(F.col("reason_end"), F.col("_ratio"), limits)
        )
        .withColumn("skipped", Q.is_skip(F.col("play_quality")))
        .withColumn("source", F.lit(SOURCE_HISTORY))
        .select(*PLAY_COLUMNS)
    )


def classify_recent(
    recent: DataFrame,
    track_data: DataFrame,
    limits: Thresholds = DEFAULTS,
    partition_cols: Sequence[str] = (),
    distinct: bool = True,
) -> DataFrame:
    """Plays of the recent log, time played inferred from the gap to the next play.

    The table of recent plays holds distinct rows; ``distinct=False`` takes that for granted.
    ``partition_cols`` (say a user id) separates the logs of several listeners.
    """
    columns = [*partition_cols, "track_name", "played_at", URI]
    log = recent.where(present(F.col(URI))).select(*columns)
    gaps = gap_to_next(log, "played_at", [URI, "track_name"], partition_cols, distinct)
    return classify_gaps(gaps, track_data, limits, partition_cols)


def classify_gaps(
    gaps: DataFrame,
    track_data: DataFrame,
    limits: Thresholds = DEFAULTS,
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """Recent plays that carry ``gap_seconds`` to ``plays`` columns."""
    gap, duration = F.col("gap_seconds"), F.col("duration_ms")
    return (
        gaps.join(durations(track_data), URI, "left")
        .withColumn("_ratio", Q.recent_ratio(gap, duration))
        .withColumn("play_percentage", Q.played_share(F.col("_ratio")))
        .withColumn("play_quality", Q.recent_quality(gap, F.col("_ratio"), limits))
        .withColumn("ms_played", Q.recent_ms(gap, duration, F.col("play_quality")))
        .withColumn("skipped", Q.is_skip(F.col("play_quality")))
        .withColumn("source", F.lit(SOURCE_RECENT))
        .select(*partition_cols, *PLAY_COLUMNS)
    )


def dedup_recent(
    recent_plays: DataFrame, history_plays: DataFrame, tolerance: int = DEFAULTS.overlap_seconds
) -> DataFrame:
    """Recent plays the history does not hold already (same track, close in time)."""
    return without_overlap(recent_plays, history_plays, tolerance, URI, "played_at")


def build_plays(
    history: DataFrame,
    recent: DataFrame,
    track_data: DataFrame,
    limits: Thresholds = DEFAULTS,
    tz: str = HOME_TIMEZONE,
    on_bad: str = "fail",
) -> DataFrame:
    """The unified play log, without its surrogate key.

    The overlap check needs only track and time of the history, so it reads the events
    before their join with the track durations. Gaps are taken before rows are removed: a
    removed play still ends the one before it.
    """
    from_history = classify_history(history, track_data, limits, tz, on_bad)
    events = history_events(history, tz, on_bad).select(URI, "played_at")
    from_recent = classify_recent(recent, track_data, limits)
    return from_history.unionByName(dedup_recent(from_recent, events, limits.overlap_seconds))


def plays_summary(plays: DataFrame) -> DataFrame:
    """Plays by source and quality; no quality is a group of its own."""
    return (
        plays.groupBy("source", "play_quality")
        .agg(F.count("*").alias("n"))
        .orderBy("source", "play_quality")
    )
