"""Track metadata: which tracks to fetch, and the table of fetched ones."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.text import track_id


def known_uris(history: DataFrame, recent: DataFrame) -> DataFrame:
    """Distinct non-NULL track URIs of both raw tables (``uri``). Empty text stays in."""
    column = F.col("spotify_track_uri").alias("uri")
    uris = history.select(column).unionByName(recent.select(column))
    return uris.where(F.col("uri").isNotNull()).distinct()


def new_uris(history: DataFrame, recent: DataFrame, track_data: DataFrame) -> DataFrame:
    """URIs without a row in ``track_data``."""
    have = track_data.select(F.col("source_uri").alias("uri"))
    return known_uris(history, recent).join(have, "uri", "left_anti")


def split_by_track_id(uris: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(recognised with ``track_id``, rejected) rows of a frame with a ``uri`` column."""
    marked = uris.withColumn("track_id", track_id(F.col("uri")))
    good = marked.where(F.col("track_id").isNotNull())
    return good, marked.where(F.col("track_id").isNull()).drop("track_id")


def uris_to_enrich(
    history: DataFrame,
    recent: DataFrame,
    track_data: DataFrame,
    cap: int | None = None,
    rejects: DataFrame | None = None,
) -> DataFrame:
    """New URIs of tracks with ``track_id``; with ``cap`` the first so many in URI order.

    URIs that are no track never count, nor do those whose lookup failed before
    (``requested_uri`` of ``rejects``), so that capped runs get to every track in turn.
    """
    found, _ = split_by_track_id(new_uris(history, recent, track_data))
    if rejects is not None:
        failed = rejects.select(F.coalesce("requested_uri", "uri").alias("uri"))
        found = found.join(failed, "uri", "left_anti")
    return found if cap is None else found.orderBy("uri").limit(cap)


def track_rows(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Track payloads to (``track_data`` rows, rejected payloads).

    A payload from a failed lookup carries no URI or no duration; storing it would mark the
    track as known for ever, so it is rejected.
    """
    source = F.coalesce("requested_uri", "uri") if "requested_uri" in payloads.columns else F.col("uri")
    usable = source.isNotNull() & F.col("duration_ms").isNotNull()
    rows = payloads.where(usable).select(
        source.alias("source_uri"),
        F.col("name").alias("track_name"),
        "duration_ms",
        "is_playable",
        "popularity",
        F.col("album.name").alias("album_name"),
        F.col("album.release_date").alias("release_date"),
        F.col("album.release_date_precision").alias("release_date_precision"),
        F.col("album.uri").alias("album_uri"),
        F.coalesce("artists", F.array().cast("array<struct<name:string,uri:string>>")).alias(
            "artists"
        ),
    )
    return rows, payloads.where(~usable)


def artist_columns(df: DataFrame) -> int:
    """How many ``artist_<i>_name`` columns a table has."""
    return sum(bool(re.fullmatch(r"artist_\d+_name", c)) for c in df.columns)


def artists_needed(existing: int = 0) -> Column:
    """Aggregate: artist columns that the rows ask for, at least ``existing``."""
    return F.greatest(F.coalesce(F.max(F.size("artists")), F.lit(0)), F.lit(existing))


def widen_artists(tracks: DataFrame, width: int | None = None) -> DataFrame:
    """Wide view of the stored array: ``artist_1_name`` … ``artist_<width>_uri``.

    Without ``width`` one number is aggregated first, so that every artist has its columns.
    """
    if width is None:
        width = tracks.agg(artists_needed()).first()[0]
    wide = [
        F.get("artists", F.lit(i))[part].alias(f"artist_{i + 1}_{part}")
        for part in ("name", "uri")
        for i in range(width)
    ]
    return tracks.select(*[c for c in tracks.columns if c != "artists"], *wide)


def unique_tracks(track_data: DataFrame, on_dup: str = "first") -> DataFrame:
    """One row per ``source_uri``: the smallest one, or an error for ``on_dup="fail"``."""
    columns = [c for c in track_data.columns if c != "source_uri"]
    picked = F.min(F.struct(*columns))
    if on_dup == "fail":
        message = F.concat(F.lit("duplicate track "), F.col("source_uri"))
        picked = F.when(F.count("*") == 1, picked).otherwise(F.raise_error(message))
    elif on_dup != "first":
        raise ValueError("on_dup is 'first' or 'fail'")
    return track_data.groupBy("source_uri").agg(picked.alias("_row")).select("source_uri", "_row.*")
