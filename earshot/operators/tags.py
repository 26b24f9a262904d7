"""Tags: playlists named after tags, tag queries, playlists built from them, axes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.schemas import TRACK_URI_PREFIX


@dataclass(frozen=True)
class TagSync:
    """Results of one sync, all lazy."""

    mapping: DataFrame  # tag_id, spotify_track_uri
    playlist_counts: DataFrame  # playlist_id, name, tag_id, track_count
    unmatched_playlists: DataFrame  # playlist_id, name
    unmatched_tags: DataFrame  # tag


def tag_lookup(tags: DataFrame) -> DataFrame:
    """Lower-case tag name to id; of names equal but for case the highest id counts."""
    return tags.groupBy(F.lower("tag").alias("tag")).agg(F.max("tag_id").alias("tag_id"))


def hashtag_playlists(playlists: DataFrame) -> DataFrame:
    """Playlists named ``#…`` with ``tag``: the name less one ``#``, lower-cased."""
    tagged = playlists.where(F.col("name").startswith("#"))
    return tagged.withColumn("tag", F.lower(F.substr(F.col("name"), F.lit(2))))


def playlist_tracks(items: DataFrame) -> DataFrame:
    """(playlist_id, spotify_track_uri) of real tracks; episodes and local files go.

    The song sits under ``item``, in older pages under ``track``.
    """
    filled = F.coalesce(F.col("item.uri"), F.col("item.type")).isNotNull()
    song = F.when(filled, F.col("item")).otherwise(F.col("track"))
    return (
        items.select("playlist_id", song.alias("song"))
        .where(
            (F.col("song.type") == "track") & F.col("song.uri").startswith(TRACK_URI_PREFIX)
        )
        .select("playlist_id", F.col("song.uri").alias("spotify_track_uri"))
    )


def sync_tags(tags: DataFrame, playlists: DataFrame, items: DataFrame) -> TagSync:
    """Tag mapping from the hashtag playlists, and what did not match.

    ``playlists``: playlist_id, name. ``items``: playlist_id, item, track.
    """
    lookup = tag_lookup(tags)
    named = hashtag_playlists(playlists)
    matched = named.join(lookup, "tag")
    tracks = playlist_tracks(items)

    mapping = (
        matched.select("playlist_id", "tag_id")
        .join(tracks, "playlist_id")
        .select("tag_id", "spotify_track_uri")
        .dropDuplicates()
    )
    sizes = tracks.groupBy("playlist_id").agg(F.count("*").alias("track_count"))
    counts = matched.join(sizes, "playlist_id", "left").select(
        "playlist_id", "name", "tag_id", F.coalesce("track_count", F.lit(0)).alias("track_count")
    )
    return TagSync(
        mapping=mapping,
        playlist_counts=counts,
        unmatched_playlists=named.join(lookup, "tag", "left_anti").select("playlist_id", "name"),
        unmatched_tags=lookup.join(named, "tag", "left_anti").select("tag").orderBy("tag"),
    )


def tag_query(
    universe: DataFrame,
    mapping: DataFrame,
    tags: DataFrame,
    names: list[str],
    where: Callable[[Callable[[str], Column]], Column],
) -> DataFrame:
    """Tracks of ``universe`` (spotify_track_uri) that satisfy a condition on tags.

    ``names`` lists the tags used, in any case and order; one that ``tags`` lacks is an error,
    and without any every track is in. ``where`` builds the condition from ``has(name)``, e.g.
    ``lambda has: has("chill") & ~has("rap")``. Untagged tracks take part, so a query of
    negative tags alone works. One aggregation of the mapping rows of these tags, one join.
    """
    wanted = list(dict.fromkeys(n.lower() for n in names))
    if not wanted:
        return universe.select("spotify_track_uri").where(where(lambda _: F.lit(False)))
    column = {name: f"_tag{i}" for i, name in enumerate(wanted)}
    chosen = tag_lookup(tags.where(F.lower("tag").isin(*wanted)))
    ids = {row.tag: row.tag_id for row in chosen.collect()}
    unknown = set(wanted) - ids.keys()
    if unknown:
        raise ValueError(f"unknown tags: {', '.join(sorted(unknown))}")
    # A filter, unlike a join, goes below whatever makes the mapping distinct.
    flags = (
        mapping.where(F.col("tag_id").isin([*ids.values()]))
        .groupBy("spotify_track_uri")
        .agg(*[F.bool_or(F.col("tag_id") == ids[name]).alias(column[name]) for name in wanted])
    )

    def has(name: str) -> Column:
        return F.coalesce(F.col(column[name.lower()]), F.lit(False))

    return (
        universe.select("spotify_track_uri")
        .join(flags, "spotify_track_uri", "left")
        .where(where(has))
        .select("spotify_track_uri")
    )


def tag_selection(
    universe: DataFrame,
    mapping: DataFrame,
    tags: DataFrame,
    all_of: tuple[str, ...] = (),
    any_of: tuple[str, ...] = (),
    none_of: tuple[str, ...] = (),
) -> DataFrame:
    """``tag_query`` for the common shape: every, at least one, none of some tags."""

    def condition(has: Callable[[str], Column]) -> Column:
        kept = F.lit(True)
        for name in all_of:
            kept = kept & has(name)
        for name in none_of:
            kept = kept & ~has(name)
        if any_of:
            some = F.lit(False)
            for name in any_of:
                some = some | has(name)
            kept = kept & some
        return kept

    return tag_query(universe, mapping, tags, [*all_of, *any_of, *none_of], condition)


def generated_playlist(
    tracks: DataFrame, playlist_id: int, name: str, uri: str | None = None, tag_id: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(``playlists`` row, ``playlist_mapping`` rows) for the result of a tag query."""
    row = tracks.sparkSession.range(1).select(
        F.lit(playlist_id).cast("bigint").alias("playlist_id"),
        F.lit(name).alias("playlist_name"),
        F.lit(uri).cast("string").alias("spotify_playlist_uri"),
        F.lit(tag_id).cast("int").alias("tag_id"),
    )
    mapping = tracks.select(
        F.lit(playlist_id).cast("bigint").alias("playlist_id"), "spotify_track_uri"
    ).dropDuplicates()
    return row, mapping


def tags_per_axis(mapping: DataFrame, tags: DataFrame, axes: DataFrame) -> DataFrame:
    """Tags each track carries on each axis."""
    placed = tags.select("tag_id", "axis_id").join(axes.select("axis_id", "axis"), "axis_id")
    return (
        mapping.join(placed, "tag_id")
        .groupBy("spotify_track_uri", "axis")
        .agg(F.count("*").alias("tag_count"))
    )


def axis_conflicts(mapping: DataFrame, tags: DataFrame, axes: DataFrame) -> DataFrame:
    """Tracks with more than one tag on an axis that should hold one."""
    return tags_per_axis(mapping, tags, axes).where(F.col("tag_count") > 1)
