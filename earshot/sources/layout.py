"""A layout of ``plays`` that answers look-ups by track and by time from few row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.times import wall_seconds
from earshot.schemas import PLAYS
from earshot.session import scratch_path
from earshot.sources.history import remove

URI = "spotify_track_uri"
#: Bits of each coordinate of the curve.
BITS = 16
SCHEMA = PLAYS.replace("play_id bigint,", "").strip() + ", uri_cell int"


def _uri_cell(uri: Column) -> Column:
    return F.pmod(F.xxhash64(uri), F.lit(1 << BITS)).cast("int")


def interleaved(x: Column, y: Column) -> Column:
    """The bits of two numbers below 2**BITS by turns: near in both is near on the curve."""
    bits = [F.shiftleft(F.shiftright(v, i).bitwiseAND(F.lit(1)), 2 * i + n) for i in range(BITS) for n, v in enumerate((x, y))]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total


def write_for_lookup(plays: DataFrame, path: str, n_files: int | None = None, row_group_bytes: int = 8 << 20) -> None:
    """Write ``plays`` along a curve through track and time, with Bloom filters on the track.

    The curve's range partitions split a track with most of the plays by time, and a busy hour by
    track. A row group covers a small part of both axes, so the minima and maxima of ``uri_cell``
    (a hash of the track) and ``played_at`` leave out most groups for either look-up; the filters
    leave out others that hold the cell but not the track. ``plays`` is computed once, into a copy below the shared
    folder that the ends of time and the ranges are taken from. One row with the ends reaches the driver.
    """
    spark, copy = plays.sparkSession, scratch_path(plays.sparkSession, "unordered")
    try:
        plays.write.parquet(copy)
        _write_ordered(spark.read.schema(plays.schema).parquet(copy), path, n_files, row_group_bytes)
    finally:
        remove(spark, copy)


def _write_ordered(plays: DataFrame, path: str, n_files: int | None, row_group_bytes: int) -> None:
    second = wall_seconds(F.col("played_at"))
    first, last = plays.agg(F.min(second), F.max(second)).first()
    width = max(1, ((last or 0) - (first or 0)) // (1 << BITS) + 1)
    time_cell = F.floor((second - F.lit(first or 0)) / width).cast("long")
    rows = plays.withColumn("uri_cell", _uri_cell(F.col(URI)))
    rows = rows.withColumn("_curve", interleaved(F.col("uri_cell").cast("long"), time_cell))
    spread = rows.repartitionByRange(n_files, "_curve") if n_files else rows.repartitionByRange("_curve")
    (
        spread.sortWithinPartitions("_curve", URI, "played_at")
        .select(*[c.split()[0] for c in SCHEMA.replace("decimal(5,4)", "decimal").split(",")])
        .write.option("parquet.block.size", row_group_bytes)
        .option(f"parquet.bloom.filter.enabled#{URI}", "true")
        .parquet(path)
    )


def look_up(spark: SparkSession, path: str, uri: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Plays of a track, of a time (both ends included), or of both; all conditions reach the scan."""
    plays = spark.read.schema(SCHEMA).parquet(path)
    if uri is not None:
        cell = spark.range(1).select(_uri_cell(F.lit(uri))).first()[0]
        plays = plays.where((F.col(URI) == uri) & (F.col("uri_cell") == cell))
    if since is not None:
        plays = plays.where(F.col("played_at") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        plays = plays.where(F.col("played_at") <= F.lit(until).cast("timestamp_ntz"))
    return plays.drop("uri_cell")
