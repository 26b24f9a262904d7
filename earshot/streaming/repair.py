"""Continuous classification that plays may reach in any order.

The log of plays lies in folders by slot of time (a day, unless told otherwise), each play with its
gap and its classification, and beside it one row per log and slot: first and last second, and the
first second of the next slot in which the log has plays. A late play changes the gaps of its own
slot and of the last second before it, perhaps in an earlier slot. Just these slots are written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot import schemas
from earshot.functions.text import present
from earshot.functions.times import wall_seconds
from earshot.operators.timeline import SECONDS_PER_DAY, gap_to_next
from earshot.plans.plays import URI, classify_gaps
from earshot.sources.slots import SlotChange, read_slots

COLUMNS = ["track_name", "played_at", URI]


def _log(keys: Sequence[str]) -> Column:
    """The log of a row as one value, so that NULL keys compare equal."""
    return F.struct(F.lit(0).alias("one"), *[F.col(k) for k in keys]).alias("_log")


def _keys_ddl(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in keys]


def _log_schema(key_ddl: list[str]) -> str:
    plays = [c.strip() for c in schemas.PLAYS.replace("decimal(5,4)", "decimal(5;4)").split(",")]
    plays = [c.replace(";", ",") for c in plays if not c.startswith("play_id")]
    return ", ".join([*key_ddl, "track_name string", "gap_seconds bigint", *plays, "slot bigint"])


def _spans_schema(key_ddl: list[str]) -> str:
    return ", ".join([*key_ddl, "first bigint", "last bigint", "next_first bigint", "slot bigint"])


def repair(
    batch: DataFrame,
    token: str,
    track_data: DataFrame,
    output: str,
    limits: schemas.Thresholds = schemas.Thresholds(),
    partition_cols: Sequence[str] = (),
    slot_seconds: int = SECONDS_PER_DAY,
) -> list[int]:
    """Add plays to the classified log below ``output``; returns the slots that were written.

    Plays that the log has already change nothing, so a batch may come again. ``token`` names
    the batch: one that broke off is completed by its next attempt. The driver sees the
    numbers of the slots, of which there are as many as days.
    """
    spark, keys = batch.sparkSession, list(partition_cols)
    key_ddl = _keys_ddl(batch, keys)
    change = SlotChange(spark, output, token)
    if change.complete():
        change.install()
        return []
    change.begin()
    second = wall_seconds(F.col("played_at"))
    slot = F.floor(second / slot_seconds).alias("slot")
    arrived = change.keep(
        batch.where(present(F.col(URI))).select(*keys, *COLUMNS, slot).dropDuplicates(), "arrived"
    )
    touched = [r.slot for r in arrived.select("slot").distinct().collect()]
    if not touched:
        change.begin()
        return []
    stored = lambda slots: read_slots(spark, f"{output}/log", _log_schema(key_ddl), "slot", slots).select(*keys, *COLUMNS, "slot")
    known = change.keep(stored(touched).unionByName(arrived).dropDuplicates(), "known")

    # The line of slots of every log that the touched ones hold, with the next slot's first second.
    fresh = known.groupBy(*keys, "slot").agg(F.min(second).alias("first"), F.max(second).alias("last"))
    spans = read_slots(spark, f"{output}/spans", _spans_schema(key_ddl), "slot").withColumnRenamed("next_first", "was")
    logs = fresh.select(_log(keys)).distinct()
    others = spans.where(~F.col("slot").isin(touched)).withColumn("_log", _log(keys)).join(logs, "_log", "left_semi").drop("_log")
    line = others.unionByName(fresh, allowMissingColumns=True).withColumn(
        "next_first", F.lead("first").over(Window.partitionBy(_log(keys)).orderBy("slot"))
    )
    moved = ~F.col("next_first").eqNullSafe(F.col("was"))
    line = change.keep(line.where(F.col("slot").isin(touched) | moved).drop("was"), "line")
    shifted = [r.slot for r in line.where(~F.col("slot").isin(touched)).select("slot").distinct().collect()]

    # A slot is written as a whole, also where the lines of few of its logs have changed.
    same = spans.where(F.col("slot").isin(shifted)).withColumnRenamed("was", "next_first")
    gone = line.select(_log(keys), "slot")
    same = same.withColumn("_log", _log(keys)).join(gone, ["_log", "slot"], "left_anti").drop("_log")
    whole = change.keep(line.unionByName(same), "spans")
    rows = known.unionByName(stored(shifted)) if shifted else known
    gaps = gap_to_next(rows, "played_at", [URI, "track_name"], [*keys, "slot"])
    ends = whole.select(_log(keys), "slot", "next_first")
    gaps = (
        gaps.withColumn("_log", _log(keys))
        .join(ends, ["_log", "slot"])
        .withColumn("gap_seconds", F.coalesce("gap_seconds", F.col("next_first") - second))
    )
    classified = classify_gaps(gaps, track_data, limits, [*keys, "track_name", "gap_seconds", "slot"])
    change.stage({"log": classified, "spans": whole}, "slot")
    change.install()
    return sorted([*touched, *shifted])


def start_repairing_classification(
    recent: DataFrame,
    track_data: DataFrame,
    output: str,
    checkpoint: str,
    limits: schemas.Thresholds = schemas.Thresholds(),
    partition_cols: Sequence[str] = (),
    slot_seconds: int = SECONDS_PER_DAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Classify a stream of recent plays; however late a play comes, the log is that of a batch run."""

    def store(batch: DataFrame, batch_id: int) -> None:
        repair(batch, f"batch-{batch_id}", track_data, output, limits, partition_cols, slot_seconds)

    return (
        recent.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def classified_log(
    spark: SparkSession, output: str, key_ddl: Sequence[str] = (), slots: Sequence[int] | None = None
) -> DataFrame:
    """The classified plays; ``key_ddl`` declares the key columns of several logs."""
    table = read_slots(spark, f"{output}/log", _log_schema([*key_ddl]), "slot", slots)
    return table.select(*[d.split()[0] for d in key_ddl], *schemas.PLAY_COLUMNS)
