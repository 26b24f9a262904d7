"""Anti-join on a key and a time tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.times import wall_seconds


def near_marks(
    df: DataFrame, tolerance: int, key: str = "spotify_track_uri", at: str = "played_at"
) -> DataFrame:
    """Per key and time slot, the seconds a row of that slot could be close to.

    Slots are ``tolerance + 1`` seconds wide, so rows of one slot are always close, and a
    row can only reach the last second of the slot before and the first of the slot after.
    Three marks per used slot thus stand for any number of rows.
    """
    second = wall_seconds(F.col(at))
    spans = df.groupBy(F.col(key), F.floor(second / (tolerance + 1)).alias("_slot")).agg(
        F.min(second).alias("_first"), F.max(second).alias("_last")
    )
    marks = F.array(
        F.struct((F.col("_slot") - 1).alias("_slot"), F.col("_first").alias("_mark")),
        F.struct(F.col("_slot").alias("_slot"), F.col("_first").alias("_mark")),
        F.struct((F.col("_slot") + 1).alias("_slot"), F.col("_last").alias("_mark")),
    )
    return spans.select(key, F.inline(marks))


def without_overlap(
    df: DataFrame,
    other: DataFrame,
    tolerance: int,
    key: str = "spotify_track_uri",
    at: str = "played_at",
    keep: str = "left_anti",
) -> DataFrame:
    """Rows of ``df`` with no row of ``other`` of the same key within ``tolerance`` seconds.

    ``keep="left_semi"`` returns the overlapping rows instead. The join key is (key, slot):
    plays of a hot key spread over its slots, and no pairs of plays are ever formed.
    """
    slots = (
        near_marks(other, tolerance, key, at)
        .withColumnRenamed(key, "_key")
        .withColumnRenamed("_slot", "_near_slot")
    )
    second = wall_seconds(F.col(at))
    return df.withColumn("_slot", F.floor(second / (tolerance + 1))).join(
        slots,
        (F.col(key) == F.col("_key"))
        & (F.col("_slot") == F.col("_near_slot"))
        & (F.abs(second - F.col("_mark")) <= tolerance),
        keep,
    ).drop("_slot")
