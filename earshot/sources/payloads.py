"""Scans of landed API pages. Paging ends at landing time: a page is a JSON file."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot import schemas
from earshot.functions.times import instant as to_instant
from earshot.functions.times import local_time


def unread_files(spark: SparkSession, folder: str, calls: DataFrame) -> list[str]:
    """The files of a folder that ``calls`` doesn't know, or that were written again since.

    Files are listed as rows, of which no content is read; only the names of the unread ones pass the
    driver.
    """
    listed = spark.read.format("binaryFile").load(folder).select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed")
    )
    known = calls.select(F.regexp_extract("page", "^(.*)#[^#]*$", 1).alias("file"), "landed")
    return sorted(r.path for r in listed.join(known, ["file", "landed"], "left_anti").select("path").collect())


#: Characters that would make a file name a pattern.
PATTERN = re.compile(r"([\[\]{}*?\\])")


def read_pages(spark: SparkSession, folder: str | Sequence[str], schema: str, located: bool = False) -> DataFrame:
    """Landed pages of a folder or of some files, one JSON document per line. Malformed pages fail the job.

    ``located`` adds ``page``, the file and a hash of the page's content, and ``landed``, when the
    file was written.
    """
    paths = folder if isinstance(folder, str) else [PATTERN.sub(r"\\\1", path) for path in folder]
    pages = spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    if not located:
        return pages
    content = F.xxhash64(F.to_json(F.struct(*pages.columns)))
    return pages.select(
        "*",
        F.concat_ws("#", F.col("_metadata.file_path"), content.cast("string")).alias("page"),
        F.col("_metadata.file_modification_time").alias("landed"),
    )


def recent_rows(pages: DataFrame, tz: str = schemas.HOME_TIMEZONE) -> DataFrame:
    """Play rows of recently-played pages, batch or stream. Missing name or URI is ``""``.

    A play without a usable time has no place in the log and fails the job.
    """
    return with_local_time(recent_items(pages), tz).drop("played_at_utc")


def recent_items(pages: DataFrame) -> DataFrame:
    """One row per play with its instant ``played_at_utc``; fails on an unusable time."""
    item = pages.select(F.explode("items").alias("item"))
    instant = to_instant(F.col("item.played_at"))
    shown = F.coalesce(F.col("item.played_at"), F.lit("(none)"))
    return item.select(
        F.coalesce("item.track.name", F.lit("")).alias("track_name"),
        F.coalesce(
            instant,
            F.raise_error(F.concat(F.lit("unusable played_at: "), shown)).cast("timestamp"),
        ).alias("played_at_utc"),
        F.coalesce("item.track.uri", F.lit("")).alias("spotify_track_uri"),
    )


def with_local_time(items: DataFrame, tz: str = schemas.HOME_TIMEZONE) -> DataFrame:
    return items.select(
        "track_name",
        local_time(F.col("played_at_utc"), tz).alias("played_at"),
        "spotify_track_uri",
        "played_at_utc",
    )


def call_rows(
    pages: DataFrame, call_made: datetime | None = None, tz: str = schemas.HOME_TIMEZONE
) -> DataFrame:
    """One audit row per page, also for a page without items. Missing cursors are 0."""
    if call_made is None:
        made = local_time(F.col("landed") if "landed" in pages.columns else F.current_timestamp(), tz)
    else:
        made = F.lit(call_made.isoformat(sep=" ")).cast("timestamp_ntz")

    def cursor(name: str):
        return F.coalesce(F.col(f"cursors.{name}").cast("bigint"), F.lit(0).cast("bigint"))

    return pages.select(
        cursor("before").alias("before_ts"),
        cursor("after").alias("after_ts"),
        made.alias("call_made"),
        *[
            (F.col(name) if name in pages.columns else F.lit(None).cast(kind)).alias(name)
            for name, kind in (("page", "string"), ("landed", "timestamp"))
        ],
    )


def scan_recent(
    spark: SparkSession, folder: str, tz: str = schemas.HOME_TIMEZONE
) -> DataFrame:
    return recent_rows(read_pages(spark, folder, schemas.RECENT_PAGE), tz)


def scan_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Track payloads, one per line; ``requested_uri`` may name the URI that was asked for."""
    return read_pages(spark, folder, schemas.TRACK_PAYLOAD)


def scan_playlists(spark: SparkSession, folder: str) -> DataFrame:
    """playlist_id, name of every playlist on every landed page."""
    pages = read_pages(spark, folder, schemas.PLAYLIST_PAGE)
    return pages.select(F.explode("items").alias("p")).select(
        F.col("p.id").alias("playlist_id"), F.col("p.name").alias("name")
    )


def scan_playlist_items(spark: SparkSession, folder: str) -> DataFrame:
    """playlist_id, item, track of every entry on every landed page."""
    pages = read_pages(spark, folder, schemas.PLAYLIST_ITEM_PAGE)
    return pages.select("playlist_id", F.explode("items").alias("e")).select(
        "playlist_id", F.col("e.item").alias("item"), F.col("e.track").alias("track")
    )
