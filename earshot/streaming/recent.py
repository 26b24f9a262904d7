"""Continuous ingest of landed recently-played pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot import schemas
from earshot.plans.ingest import new_recent_rows
from earshot.sources import payloads
from earshot.sources.tables import write_table


def page_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Pages as they land in a folder."""
    reader = spark.readStream.schema(schemas.RECENT_PAGE).option("mode", "FAILFAST")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def distinct_recent(
    pages: DataFrame, tz: str = schemas.HOME_TIMEZONE, look_back: str = "2 days"
) -> DataFrame:
    """Plays of a page stream without the overlap of consecutive polls.

    State is bounded by ``look_back``, which must cover what one poll can reach back to:
    older plays than that behind the newest are late and dropped. Where no play may be lost
    use ``start_recent_ingest``, which checks against the stored table.
    """
    plays = payloads.with_local_time(payloads.recent_items(pages), tz)
    return (
        plays.withWatermark("played_at_utc", look_back)
        .dropDuplicatesWithinWatermark(["track_name", "played_at", "spotify_track_uri"])
        .drop("played_at_utc")
    )


def start_recent_ingest(
    pages: DataFrame,
    recent_table: str,
    calls_table: str,
    checkpoint: str,
    tz: str = schemas.HOME_TIMEZONE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append new plays and an audit row per page, exactly once.

    A batch that is run again after a failure adds nothing: plays are checked against the
    table, and audit rows go to a folder per batch, which is replaced.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        calls = payloads.call_rows(batch, None, tz)
        calls.write.mode("overwrite").parquet(f"{calls_table}/batch_id={batch_id}")
        rows = payloads.recent_rows(batch, tz)
        write_table(new_recent_rows(spark, rows, recent_table), recent_table)

    return (
        pages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_table(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream's rows to a Parquet table."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def session_windows(
    plays: DataFrame,
    at: str,
    gap_seconds: int,
    partition_cols: Sequence[str],
    delay: str = "1 hour",
) -> DataFrame:
    """Listening sessions of a stream with an event time column (TIMESTAMP).

    A gap of exactly ``gap_seconds`` still belongs to the session, one second more does
    not. The session ends at its last play, not at the end of the window. Session state
    needs a key, so a log of one listener must still name a column for it.
    """
    window = F.session_window(F.col(at), f"{gap_seconds} seconds")
    grouped = plays.withWatermark(at, delay).groupBy(*partition_cols, window.alias("w"))
    return grouped.agg(F.max(at).alias("session_end"), F.count("*").alias("play_count")).select(
        *partition_cols, F.col("w.start").alias("session_start"), "session_end", "play_count"
    )


#: State on local disk with checkpoints, and sessions merged before the shuffle, so that a user with
#: most of the plays sends sessions, not plays.
SESSION_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def start_sessions(
    plays: DataFrame,
    at: str,
    gap_seconds: int,
    partition_cols: Sequence[str],
    path: str,
    checkpoint: str,
    delay: str = "1 hour",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the sessions of a stream once they are over.

    A session is over when the watermark, ``delay`` behind the newest play, is ``gap_seconds`` past its
    last play. It then leaves the state, which holds open sessions only, and is never written again.
    """
    spark = plays.sparkSession
    before = {key: spark.conf.get(key, None) for key in SESSION_SETTINGS}
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        windows = session_windows(plays, at, gap_seconds, partition_cols, delay)
        return stream_table(windows, path, checkpoint, trigger)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
