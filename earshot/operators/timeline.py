"""Neighbours on a time line: gap to the next row, and sessions split by long gaps.

A window over a whole log would put every row into one task, and a window per day or per
second still puts a hot day or second there. Both operators therefore work on the
*distinct seconds*: partial aggregation folds the rows of a second before any shuffle, a
day holds at most 86,400 seconds however many rows fall into it, and the only window
without a day in its key runs over one row per day. Rows meet their second again in an
equi-join, where AQE may split a hot second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.times import from_wall_seconds, wall_seconds

SECONDS_PER_DAY = 86_400


def _day() -> Column:
    return F.floor(F.col("_sec") / SECONDS_PER_DAY)


def _log(cols: Sequence[str]) -> tuple[list[str], list[Column]]:
    """Key naming the log a row belongs to: one struct, so that NULLs compare equal."""
    if not cols:
        return [], []
    return ["_log"], [F.struct(*[F.col(c) for c in cols]).alias("_log")]


def _next_seconds(seconds: DataFrame, log: list[str]) -> DataFrame:
    """Add ``_next``: the next distinct second of the same log, or NULL."""
    # One row per day, so this window stays small although it has no day in its key. Days fold
    # from the seconds, not from the rows, which are read once less.
    days = (
        seconds.groupBy(*log, _day().alias("_day"))
        .agg(F.min("_sec").alias("_first"))
        .withColumn("_next_first", F.lead("_first").over(Window.partitionBy(*log).orderBy("_day")))
        .drop("_first")
    )
    in_day = Window.partitionBy(*log, "_day").orderBy("_sec")
    return (
        seconds.withColumn("_day", _day())
        .withColumn("_next", F.lead("_sec").over(in_day))
        .join(days, [*log, "_day"])
        .withColumn("_next", F.coalesce("_next", "_next_first"))
        .drop("_day", "_next_first")
    )


def gap_to_next(
    df: DataFrame,
    at: str,
    tiebreak: Sequence[str],
    partition_cols: Sequence[str] = (),
    distinct: bool = False,
) -> DataFrame:
    """Add ``gap_seconds``: whole seconds to the next row by ``at``, then ``tiebreak``.

    NULL marks the last row of its log. ``at``, ``tiebreak`` and ``partition_cols`` together
    must identify a row; ``distinct=True`` drops copies of rows first. Copies agree in their
    second and in their gap, so they are dropped after the join with the seconds, on whose
    partitioning that takes no further shuffle.
    """
    log, log_key = _log(partition_cols)
    key = F.struct(*[F.col(c) for c in tiebreak])
    second = wall_seconds(F.col(at)).alias("_sec")

    rows = df.select(*log_key, second, key.alias("_key")).where(F.col("_sec").isNotNull())
    last = rows.groupBy(*log, "_sec").agg(F.max("_key").alias("_last"))
    axis = _next_seconds(last, log)

    gap = F.when(key.eqNullSafe(F.col("_last")), F.col("_next") - F.col("_sec")).when(
        F.col("_sec").isNotNull(), F.lit(0)
    )
    joined = df.select("*", *log_key, second).join(axis, [*log, "_sec"], "left")
    found = joined.select(*df.columns, *log, "_sec", gap.alias("gap_seconds"))
    return (found.dropDuplicates() if distinct else found).drop(*log, "_sec")


def sessions(
    df: DataFrame, at: str, gap_seconds: int, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """One row per session: start, end, number of plays. A gap above the limit splits.

    Columns: the partition columns, ``session_start``, ``session_end``, ``play_count``.
    """
    log, log_key = _log(partition_cols)
    day_key = [*log, "_day"]
    over_days = Window.partitionBy(*log).orderBy("_day")
    in_day = Window.partitionBy(*day_key).orderBy("_sec")

    rows = df.select(*log_key, wall_seconds(F.col(at)).alias("_sec"))
    rows = rows.where(F.col("_sec").isNotNull())
    seconds = rows.groupBy(*log, "_sec").agg(F.count("*").alias("_n"))
    before = (
        rows.groupBy(*log, _day().alias("_day"))
        .agg(F.max("_sec").alias("_day_last"))
        .withColumn("_before", F.lag("_day_last").over(over_days))
        .drop("_day_last")
    )
    previous = F.coalesce("_prev", "_before")
    starts = previous.isNull() | (F.col("_sec") - previous > gap_seconds)
    labelled = (
        seconds.withColumn("_day", _day())
        .withColumn("_prev", F.lag("_sec").over(in_day))
        .join(before, day_key)
        .withColumn("_start", F.when(starts, F.col("_sec")))
        .withColumn("_start", F.max("_start").over(in_day))
    )
    # A day folds to its sessions. The piece before its first start has no label yet and
    # belongs to the latest session of the days before.
    pieces = labelled.groupBy(*day_key, "_start").agg(
        F.max("_sec").alias("_to"), F.sum("_n").alias("_n")
    )
    # A hot log has many pieces, so the window over them goes through one row per day again.
    # Asking for the count here as well lets Spark use the shuffled seconds twice.
    carried = over_days.rowsBetween(Window.unboundedPreceding, -1)
    still_open = (
        pieces.groupBy(*day_key)
        .agg(F.max("_start").alias("_latest"), F.sum("_n").alias("_day_n"))
        .where(F.col("_day_n") > 0)
        .withColumn("_open", F.max("_latest").over(carried))
        .drop("_latest", "_day_n")
    )
    return (
        pieces.join(still_open, day_key)
        .groupBy(*log, F.coalesce("_start", "_open").alias("_start"))
        .agg(F.max("_to").alias("_to"), F.sum("_n").alias("play_count"))
        .select(
            *[f"_log.{c}" for c in partition_cols],
            from_wall_seconds(F.col("_start")).alias("session_start"),
            from_wall_seconds(F.col("_to")).alias("session_end"),
            "play_count",
        )
    )
