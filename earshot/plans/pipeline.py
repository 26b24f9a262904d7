"""The whole chain, table to table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot import schemas
from earshot.operators.tags import TagSync, generated_playlist, sync_tags
from earshot.plans.plays import build_plays, plays_summary
from earshot.plans.stats import track_stats
from earshot.sources import payloads
from earshot.sources.tables import (
    TAG_MAPPING_RULES,
    TRACK_DATA_RULES,
    check_constraints,
    overwrite,
    read_or_empty,
    read_required,
    recover,
    write_plays,
    write_stats,
)


@dataclass(frozen=True)
class Tables:
    """Where the tables live, below one base path."""

    base: str

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"


def rebuild_plays(
    spark: SparkSession, tables: Tables, limits: schemas.Thresholds = schemas.Thresholds()
) -> DataFrame:
    """Rebuild ``plays`` from the raw tables; returns the summary by source and quality.

    All three must be there: a missing one is an error, and ``plays`` stays as it was.
    """
    history = read_required(spark, tables.path("raw_extended_history"), schemas.HISTORY)
    recent = read_required(spark, tables.path("raw_recently_played"), schemas.RECENT)
    tracks = read_required(spark, tables.path("track_data"), schemas.TRACK_DATA)
    check_constraints(tracks, **TRACK_DATA_RULES)
    path = tables.path("plays")
    write_plays(build_plays(history, recent, tracks, limits), path)
    return plays_summary(read_required(spark, path, schemas.PLAYS))


def rebuild_track_stats(
    spark: SparkSession, tables: Tables, as_of: Column | None = None
) -> DataFrame:
    """Rebuild ``track_stats`` from ``plays``; returns the table."""
    tracks = read_required(spark, tables.path("track_data"), schemas.TRACK_DATA)
    plays = read_required(spark, tables.path("plays"), schemas.PLAYS)
    path = tables.path("track_stats")
    write_stats(track_stats(plays, tracks, as_of), path)
    return read_required(spark, path, schemas.TRACK_STATS)


def rebuild_tag_mapping(
    spark: SparkSession, tables: Tables, playlist_pages: str, item_pages: str
) -> TagSync:
    """Replace ``tag_mapping`` by what the landed playlist pages say, be it nothing."""
    tags = read_required(spark, tables.path("tags"), schemas.TAG_TABLE)
    result = sync_tags(
        tags,
        payloads.scan_playlists(spark, playlist_pages),
        payloads.scan_playlist_items(spark, item_pages),
    )
    overwrite(result.mapping, tables.path("tag_mapping"), **TAG_MAPPING_RULES)
    return result


def store_playlist(
    spark: SparkSession,
    tables: Tables,
    tracks: DataFrame,
    name: str,
    uri: str | None = None,
    tag_id: int | None = None,
) -> int:
    """Store the result of a tag query as a playlist, or anew under its name; returns its id.

    ``playlists`` gets a row, ``playlist_mapping`` a folder with its tracks, written first: a playlist
    that has a row has its tracks.
    """
    path, mapping_path = tables.path("playlists"), tables.path("playlist_mapping")
    recover(spark, path)
    playlists = read_or_empty(spark, path, schemas.PLAYLISTS)
    same = F.col("playlist_name") == name
    own, highest = playlists.agg(F.max(F.when(same, F.col("playlist_id"))), F.max("playlist_id")).first()
    playlist_id = own if own is not None else (highest or 0) + 1
    row, mapping = generated_playlist(tracks, playlist_id, name, uri, tag_id)
    mapping.drop("playlist_id").write.mode("overwrite").parquet(f"{mapping_path}/playlist_id={playlist_id}")
    others = playlists.where(F.col("playlist_id") != playlist_id)
    overwrite(others.unionByName(row), path, not_null=["playlist_id", "playlist_name"], key=["playlist_id"])
    return playlist_id


def stored_playlists(spark: SparkSession, tables: Tables) -> DataFrame:
    """playlist_id, playlist_name, spotify_track_uri of all stored playlists."""
    mapping = read_or_empty(spark, tables.path("playlist_mapping"), "spotify_track_uri string, playlist_id bigint")
    playlists = read_required(spark, tables.path("playlists"), schemas.PLAYLISTS)
    return playlists.join(mapping, "playlist_id").select("playlist_id", "playlist_name", "spotify_track_uri")
