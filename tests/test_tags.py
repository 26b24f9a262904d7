import json
from pathlib import Path

import pytest
from conftest import rows

from earshot import schemas
from earshot.operators.tags import (
    axis_conflicts,
    generated_playlist,
    sync_tags,
    tag_query,
    tag_selection,
    tags_per_axis,
)
from earshot.plans.pipeline import Tables, rebuild_tag_mapping
from earshot.sources import payloads
from earshot.sources.tables import read_table

TAGS = [(1, "chill", None, 1), (2, "rap", None, 3), (3, "Lonely", None, 2), (4, "lofi", None, 1)]
LISTS = [("p1", "#Chill"), ("p2", "##chill"), ("p3", "chill"), ("p4", "#unknown"), ("p5", "#rap"),
         ("p6", "#LOFI"), ("p7", None), ("p8", "#chill")]
SONG = lambda uri, kind="track": {"uri": uri, "type": kind}
ITEMS = {
    "p1": [
        {"item": SONG("spotify:track:a")},
        {"track": SONG("spotify:track:b")},
        {"item": {}, "track": SONG("spotify:track:c")},
        {"item": SONG("spotify:episode:e", "episode")},
        {"item": SONG("spotify:local:l")},
        {"item": SONG("spotify:track:a")},
        {},
    ],
    "p2": [{"item": SONG("spotify:track:z")}],
    "p6": [{"item": SONG("spotify:track:a")}],
    "p8": [{"item": SONG("spotify:track:d")}],
}


def frames(spark):
    tags = spark.createDataFrame(TAGS, schemas.TAG_TABLE)
    playlists = spark.createDataFrame(LISTS, "playlist_id string, name string")
    song = "struct<uri:string,type:string>"
    data = [
        (p, *[tuple(e[k].get(f) for f in ("uri", "type")) if k in e else None
              for k in ("item", "track")])
        for p, entries in ITEMS.items() for e in entries
    ]
    items = spark.createDataFrame(data, f"playlist_id string, item {song}, track {song}")
    return tags, playlists, items


def test_sync(spark):
    result = sync_tags(*frames(spark))
    t = "spotify:track:"
    assert rows(result.mapping) == [(1, f"{t}{x}") for x in "abcd"] + [(4, f"{t}a")]
    assert rows(result.playlist_counts) == [
        ("p1", "#Chill", 1, 4), ("p5", "#rap", 2, 0), ("p6", "#LOFI", 4, 1), ("p8", "#chill", 1, 1),
    ]
    assert rows(result.unmatched_playlists) == [("p2", "##chill"), ("p4", "#unknown")]
    assert [r.tag for r in result.unmatched_tags.collect()] == ["lonely"]


def test_pages_to_mapping_and_back_to_nothing(spark, folder):
    lists, items, none = (Path(folder) / x for x in ("lists", "items", "none"))
    for path in (lists, items, none):
        path.mkdir()
    half = len(LISTS) // 2
    for i, part in enumerate((LISTS[:half], LISTS[half:])):
        entries = [{"id": p, "name": n} for p, n in part]
        (lists / f"{i}.json").write_text(json.dumps({"items": entries}))
    pages = [{"playlist_id": p, "items": e, "next": None} for p, e in ITEMS.items()]
    (items / "1.json").write_text("\n".join(map(json.dumps, pages)))
    (none / "1.json").write_text(json.dumps({"items": []}))

    assert payloads.scan_playlists(spark, str(lists)).count() == len(LISTS)
    tables = Tables(f"{folder}/base")
    spark.createDataFrame(TAGS, schemas.TAG_TABLE).write.parquet(tables.path("tags"))
    rebuild_tag_mapping(spark, tables, str(lists), str(items))
    assert read_table(spark, tables.path("tag_mapping")).count() == 5
    rebuild_tag_mapping(spark, tables, str(none), str(items))
    assert read_table(spark, tables.path("tag_mapping")).count() == 0


def test_tag_queries_and_playlists(spark):
    tags, *_ = frames(spark)
    mapping = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (4, "a")], schemas.TAG_MAPPING)
    universe = spark.createDataFrame([(x,) for x in "abc"], "spotify_track_uri string")

    def select(**wanted):
        return [r[0] for r in rows(tag_selection(universe, mapping, tags, **wanted))]

    assert select(all_of=("CHILL",)) == ["a", "b"]
    assert select(all_of=("chill", "rap")) == ["b"]
    assert select(any_of=("rap", "lofi")) == ["a", "b"]
    assert select(none_of=("rap", "lofi")) == ["c"]
    assert select(all_of=("chill",), none_of=("rap",)) == ["a"]
    either = tag_query(
        universe, mapping, tags, ["chill", "rap"], lambda has: ~has("chill") | has("rap")
    )
    assert [r[0] for r in rows(either)] == ["b", "c"]
    row, tracks = generated_playlist(either, 9, "mix")
    assert rows(row) == [(9, "mix", None, None)]
    assert rows(tracks) == [(9, "b"), (9, "c")]


def test_axes(spark):
    tags, *_ = frames(spark)
    axes = spark.createDataFrame(
        [(i, a, None) for i, a in enumerate(schemas.AXES, 1)], schemas.AXIS_TABLE
    )
    mapping = spark.createDataFrame([(1, "a"), (4, "a"), (2, "a"), (2, "b")], schemas.TAG_MAPPING)
    per_axis = rows(tags_per_axis(mapping, tags, axes))
    assert per_axis == [("a", "Energy", 2), ("a", "Genre", 1), ("b", "Genre", 1)]
    assert rows(axis_conflicts(mapping, tags, axes)) == [("a", "Energy", 2)]


def test_repeated_missing_and_unknown_tags(spark):
    tags = spark.createDataFrame([(1, "Blue", None, 1), (2, "red", None, 1)], schemas.TAG_TABLE)
    mapping = spark.createDataFrame([(1, "a"), (2, "b")], schemas.TAG_MAPPING)
    universe = spark.createDataFrame([("a",), ("b",), ("c",)], "spotify_track_uri string")
    pick = lambda **wanted: [r[0] for r in rows(tag_selection(universe, mapping, tags, **wanted))]
    assert pick(all_of=("blue",), any_of=("BLUE", "red")) == ["a"]
    assert pick() == ["a", "b", "c"]
    with pytest.raises(ValueError, match="unknown tags: green"):
        pick(none_of=("green",))


def test_only_rows_of_the_asked_tags_are_made_distinct(spark, folder):
    tags, playlists, items = frames(spark)
    mapping = sync_tags(tags, playlists, items).mapping
    mapping.write.parquet(f"{folder}/mapping")
    stored = spark.read.schema(mapping.schema).parquet(f"{folder}/mapping").dropDuplicates()
    found = tag_query(mapping.select("spotify_track_uri").distinct(), stored, tags, ["chill", "lofi"], lambda has: has("chill") & has("lofi"))
    assert rows(found) == [("spotify:track:a",)]
    assert "In(tag_id, [1,4])" in found._jdf.queryExecution().executedPlan().toString()
