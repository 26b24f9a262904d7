"""Continuous classification of recent plays, and their overlap check with the history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot import schemas
from earshot.functions.text import present
from earshot.functions.times import wall_seconds
from earshot.operators.overlap import without_overlap
from earshot.operators.timeline import gap_to_next
from earshot.plans.plays import URI, classify_gaps
from earshot.sources.history import remove
from earshot.sources.slots import read_slots
from earshot.sources.tables import read_or_empty

COLUMNS = ["track_name", "played_at", URI]


def start_classification(
    recent: DataFrame,
    track_data: DataFrame,
    output: str,
    checkpoint: str,
    limits: schemas.Thresholds = schemas.Thresholds(),
    partition_cols: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Classify a stream of distinct recent plays as soon as their next play is known.

    The last play of each log waits in ``<output>/open``; every batch starts from the open
    plays of the batch before. Finished plays go to ``<output>/plays``. A play older than
    its log's open play comes too late to be the next of anything: it goes to
    ``<output>/late`` for the next full rebuild. All folders are per batch and replaced as a
    whole, so a batch that is run again leaves the same files.
    """
    keys = list(partition_cols)
    schema = ", ".join(
        [*(f"{f.name} {f.dataType.simpleString()}" for f in recent.schema if f.name in keys)]
        + [schemas.RECENT]
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def part(name: str, number: int) -> str:
            return f"{output}/{name}/batch_id={number}"

        def write(df: DataFrame, name: str) -> None:
            df.write.mode("overwrite").parquet(part(name, batch_id))

        rows = batch.where(present(F.col(URI))).select(*keys, *COLUMNS)
        waiting = read_or_empty(spark, part("open", batch_id - 1), schema)
        log = F.struct(F.lit(0), *[F.col(c) for c in keys]).alias("_log")
        since = waiting.select(log, F.col("played_at").alias("_since"))
        marked = rows.select("*", log).join(since, "_log", "left").drop("_log")
        too_late = F.coalesce(F.col("played_at") < F.col("_since"), F.lit(False))
        write(marked.where(too_late).drop("_since"), "late")

        known = marked.where(~too_late).drop("_since").unionByName(waiting)
        gaps = gap_to_next(known, "played_at", [URI, "track_name"], keys, distinct=True).persist()
        write(gaps.where(F.col("gap_seconds").isNull()).drop("gap_seconds"), "open")
        done = gaps.where(F.col("gap_seconds").isNotNull())
        write(classify_gaps(done, track_data, limits, keys), "plays")
        gaps.unpersist()
        # A batch that is run again needs the open plays of the batch before it, none older.
        remove(spark, part("open", batch_id - 2))

    return (
        recent.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def classified_so_far(
    spark: SparkSession, output: str, track_data: DataFrame, last_batch: int, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """Finished plays and, unclassified as in a batch run, the open ones."""
    done = spark.read.parquet(f"{output}/plays").drop("batch_id")
    waiting = spark.read.parquet(f"{output}/open/batch_id={last_batch}")
    open_plays = waiting.withColumn("gap_seconds", F.lit(None).cast("bigint"))
    return done.unionByName(
        classify_gaps(open_plays, track_data, partition_cols=list(partition_cols))
    )


def stream_without_overlap(
    recent: DataFrame, history_plays: DataFrame, tolerance: int = schemas.Thresholds().overlap_seconds
) -> DataFrame:
    """Stream of recent plays the (static) history does not hold: a stream-static anti-join."""
    return without_overlap(recent, history_plays, tolerance)


def start_overlap_check(
    recent: DataFrame,
    history_plays: DataFrame,
    output: str,
    checkpoint: str,
    tolerance: int = schemas.Thresholds().overlap_seconds,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The same per batch, against the part of the history the batch's times can reach.

    The anti-join above prepares the whole history again for every batch. Here two values
    of the batch bound it first, which a history laid out by time turns into a short scan.
    Output folders are per batch and replaced as a whole.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        played = F.col("played_at")
        ends = batch.agg(F.min(played).cast("string"), F.max(played).cast("string")).first()
        first, last = (F.lit(end).cast("timestamp_ntz") for end in ends)
        reach = F.make_dt_interval(secs=F.lit(tolerance))
        near = history_plays.where(played.between(first - reach, last + reach))
        kept = without_overlap(batch, near, tolerance)
        kept.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return (
        recent.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _instant(local: str) -> Column:
    """Wall-clock time as the TIMESTAMP that watermarks need, read as UTC whatever the session's zone."""
    return F.timestamp_seconds(wall_seconds(F.col(local)))


def stream_without_stream_overlap(
    recent: DataFrame,
    history: DataFrame,
    tolerance: int = schemas.Thresholds().overlap_seconds,
    delay: str = "1 hour",
) -> DataFrame:
    """Recent plays that a *stream* of history plays does not hold, each once it is certain.

    An outer join of two streams within ``tolerance`` seconds, both with a watermark: a play without
    a partner comes out when no history play of its time can arrive any more, and both sides forget
    what is past. Plays meet by track and time slot, so those of a hot track spread over its slots;
    a history play stands in the slots beside its own as well.
    """
    width = tolerance + 1
    at = _instant("played_at")
    slot = F.floor(wall_seconds(F.col("played_at")) / width)
    left = recent.select("*", at.alias("_at"), slot.alias("_slot")).withWatermark("_at", delay)
    near = history.select(
        F.col(URI).alias("_uri"),
        at.alias("_there"),
        F.explode(F.array(slot - 1, slot, slot + 1)).alias("_near"),
    ).withWatermark("_there", delay)
    reach = F.expr(f"INTERVAL '{tolerance}' SECOND")  # a literal, from which Spark derives when to forget
    met = (
        (F.col(URI) == F.col("_uri"))
        & (F.col("_slot") == F.col("_near"))
        & F.col("_there").between(F.col("_at") - reach, F.col("_at") + reach)
    )
    return left.join(near, met, "left_outer").where(F.col("_uri").isNull()).select(*recent.columns)


HISTORY_BY_DAY = f"{URI} string, played_at timestamp_ntz, day date"


def write_history_by_day(events: DataFrame, path: str) -> None:
    """Track and time of history plays, in a folder per day, for checks that look into few days."""
    rows = events.select(URI, "played_at", F.to_date("played_at").alias("day"))
    rows.hint("rebalance", "day").sortWithinPartitions("day", URI).write.partitionBy("day").parquet(path)


def near_history(
    batch: DataFrame, path: str, tolerance: int = schemas.Thresholds().overlap_seconds
) -> DataFrame:
    """The history of the days that a batch of plays reaches: the filter is one on folders.

    The driver sees the batch's days, not its plays.
    """
    reach = F.make_dt_interval(secs=F.lit(tolerance))
    days = F.array(*[F.to_date(t) for t in (F.col("played_at") - reach, F.col("played_at") + reach)])
    found = [r.day for r in batch.select(F.explode(days).alias("day")).distinct().collect()]
    return read_slots(batch.sparkSession, path, HISTORY_BY_DAY, "day", found)


def start_overlap_check_by_day(
    recent: DataFrame,
    history_by_day: str,
    output: str,
    checkpoint: str,
    tolerance: int = schemas.Thresholds().overlap_seconds,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Recent plays the history does not hold, each batch against the days of the history it reaches."""

    def store(batch: DataFrame, batch_id: int) -> None:
        kept = without_overlap(batch, near_history(batch, history_by_day, tolerance), tolerance)
        kept.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return (
        recent.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
