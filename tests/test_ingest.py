import json
import os
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows

from earshot import schemas
from earshot.operators.clean import clean, drop_empty_columns, normalize_columns, trim_strings
from earshot.operators.enrich import (
    artist_columns,
    artists_needed,
    split_by_track_id,
    track_rows,
    unique_tracks,
    uris_to_enrich,
    widen_artists,
)
from earshot.plans import ingest
from earshot.plans.pipeline import Tables, rebuild_plays, rebuild_track_stats
from earshot.sources import payloads
from earshot.sources.history import scan_history
from earshot.sources.payloads import unread_files
from earshot.sources.tables import (
    check_constraints,
    constraint_violations,
    overwrite,
    read_or_empty,
    read_table,
    write_table,
)

PLAY = {"ts": "2024-01-01T00:00:00Z", "ms_played": 1, "spotify_track_uri": "spotify:track:a"}


def put(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(Path(folder))


def history_folder(folder):
    """An array over many lines, an array on one line, line-delimited rows, and bystanders."""
    rows_of = lambda n: [{**PLAY, "ms_played": n * 10 + i} for i in range(3)]
    put(folder, "in/a.json", "﻿ \n" + json.dumps(rows_of(1), indent=2))
    put(folder, "in/b.json", json.dumps(rows_of(2)))
    put(folder, "in/c.json", "\n".join(json.dumps(r) for r in rows_of(3)))
    put(folder, "in/empty.json", "[]")
    put(folder, "in/sub/x.json", json.dumps(rows_of(4)))
    put(folder, "in/x.txt", json.dumps(rows_of(5)))
    return f"{folder}/in"


def test_scan_reads_every_shape_and_nothing_else(spark, folder):
    found = rows(scan_history(spark, history_folder(folder)), "ms_played")
    assert found == [(n * 10 + i,) for n in (1, 2, 3) for i in range(3)]


def test_scan_guards(spark, folder):
    put(folder, "none/readme.txt", "")
    assert scan_history(spark, f"{folder}/none") is None
    assert ingest.ingest_history(spark, f"{folder}/none", f"{folder}/t") is None
    with pytest.raises(NotADirectoryError):
        scan_history(spark, f"{folder}/none/readme.txt")
    with pytest.raises(NotADirectoryError):
        scan_history(spark, f"{folder}/missing")
    put(folder, "bad/a.json", '{"ts": "2024')
    with pytest.raises(Exception, match="(?i)malformed|corrupt|fail"):
        scan_history(spark, f"{folder}/bad").collect()


def test_inferred_columns_of_ragged_files(spark, folder):
    put(folder, "in/a.json", json.dumps([{**PLAY, " Reason End ": "fwdbtn"}], indent=1))
    put(folder, "in/b.json", json.dumps({**PLAY, "reason_end": "trackdone", "new one": 5}))
    found = scan_history(spark, f"{folder}/in", schema=None)
    assert sorted(found.columns) == sorted([*PLAY, "reason_end", "new_one"])
    assert rows(found, "reason_end", "new_one") == [("fwdbtn", None), ("trackdone", 5)]


def test_ingest_keeps_every_key(spark, folder):
    odd = {" TS ": PLAY["ts"], "MS_PLAYED": 7, " Reason End ": "fwdbtn", "extra col": {"a": [1]}}
    put(folder, "in/a.json", json.dumps([odd], indent=1))
    put(folder, "in/b.json", json.dumps({**PLAY, "skipped": True, "gone": None}) + "\n\n")
    counts = ingest.ingest_history(spark, f"{folder}/in", f"{folder}/raw")
    assert counts.columns == ["ts", "ms_played", "spotify_track_uri", "reason_end", "skipped", "extra_col"]
    stored = read_table(spark, f"{folder}/raw")
    assert dict(stored.dtypes)["ms_played"] == "bigint" and dict(stored.dtypes)["skipped"] == "boolean"
    assert rows(stored, "ts", "ms_played", "reason_end", "extra_col") == [
        (PLAY["ts"], 1, None, None), (PLAY["ts"], 7, "fwdbtn", '{"a":[1]}')
    ]
    put(folder, "bad/a.json", json.dumps({**PLAY, "ms_played": "many"}))
    with pytest.raises(Exception, match="many"):
        ingest.ingest_history(spark, f"{folder}/bad", f"{folder}/raw")
    assert read_table(spark, f"{folder}/raw").count() == 2


def test_cleaning_steps(spark):
    df = spark.createDataFrame(
        [(" a\t", "x", None, 1), ("a", "x", None, 1), (" b \n", None, None, 2)],
        "` Track Name ` string, track_name string, gone string, N int",
    )
    named = normalize_columns(df)
    assert named.columns == ["track_name", "gone", "n"]
    assert drop_empty_columns(named).columns == ["track_name", "n"]
    assert rows(clean(df)) == [("a", 1), ("b", 2)]
    one_name = df.drop("track_name")
    assert rows(trim_strings(one_name), "` Track Name `") == [("a",), ("a",), ("b",)]
    merged = normalize_columns(df.select("track_name", "` Track Name `"))
    assert rows(merged) == [("x",), ("x",), (" b \n",)]


def test_ingest_history_cleans_and_appends(spark, folder):
    padded = {**PLAY, "reason_end": " fwdbtn "}
    put(folder, "in/a.json", json.dumps([padded, {**PLAY, "ms_played": 2}], indent=1))
    put(folder, "in/b.json", json.dumps({**PLAY, "reason_end": "fwdbtn"}))
    table = f"{folder}/raw"
    counts = ingest.ingest_history(spark, f"{folder}/in", table)
    assert (counts.read, counts.written) == (3, 2)
    assert counts.columns == ["ts", "ms_played", "spotify_track_uri", "reason_end"]
    assert rows(read_table(spark, table), "ms_played", "reason_end") == [(1, "fwdbtn"), (2, None)]

    ingest.ingest_history(spark, f"{folder}/in", table)
    assert read_table(spark, table).count() == 4
    again = ingest.ingest_history(spark, f"{folder}/in", table, dedupe_existing=True)
    assert again.written == 0
    ingest.ingest_history(spark, f"{folder}/in", table, if_exists="replace", clean=False)
    stored = read_table(spark, table)
    assert stored.count() == 3 and rows(stored, "reason_end")[-1] == ("fwdbtn",)
    with pytest.raises(Exception, match="(?i)already exists"):
        ingest.ingest_history(spark, f"{folder}/in", table, if_exists="fail")


def page(items, cursors=None):
    return json.dumps({"items": items, **({"cursors": cursors} if cursors else {})})


def item(time, name=None, uri=None):
    track = {k: v for k, v in (("name", name), ("uri", uri)) if v}
    return {"played_at": time, **({"track": track} if track else {})}


def test_ingest_recent(spark, folder):
    a = item("2024-06-01T14:00:00.499Z", "A", "spotify:track:a")
    b = item("2024-06-01T14:03:00.500Z", "B", "spotify:track:b")
    c = item("2024-01-01T14:03:00Z")
    put(folder, "one/1.json", page([a, b], {"before": "5", "after": "9"}))
    put(folder, "two/2.json", page([b, c], {"before": None}))
    put(folder, "two/3.json", page([]))
    recent, calls = f"{folder}/recent", f"{folder}/calls"
    made = datetime(2024, 6, 1, 10, 5)
    for pages in ("one", "two", "two"):
        ingest.ingest_recent(spark, f"{folder}/{pages}", recent, calls, call_made=made)
    assert rows(read_table(spark, recent), "track_name", "played_at", "spotify_track_uri") == [
        ("", datetime(2024, 1, 1, 9, 3), ""),
        ("A", datetime(2024, 6, 1, 10, 0), "spotify:track:a"),
        ("B", datetime(2024, 6, 1, 10, 3, 1), "spotify:track:b"),
    ]
    assert rows(read_table(spark, calls), "before_ts", "after_ts", "call_made") == [(0, 0, made)] * 2 + [(5, 9, made)]


def test_recent_play_without_time_fails(spark, folder):
    put(folder, "in/1.json", page([item("never", "A", "u")]))
    with pytest.raises(Exception, match="unusable played_at"):
        payloads.scan_recent(spark, f"{folder}/in").collect()


def payload(uri, artists, **extra):
    named = [{"name": f"n{i}", "uri": f"u{i}"} for i in range(1, artists + 1)]
    return {"uri": uri, "name": "N", "duration_ms": 1000, "artists": named, **extra}


def test_ingest_tracks(spark, folder):
    album = {"name": "Al", "release_date": "1999", "release_date_precision": "year", "uri": "al"}
    lines = [
        payload("spotify:track:a", 0),
        payload("spotify:track:b", 1, album=album, is_playable=True, popularity=7),
        payload("spotify:track:c", 12),
        payload("spotify:track:b", 1, album=album, is_playable=True, popularity=7),
        payload("spotify:track:d", 1, requested_uri="https://open.spotify.com/track/d?si=1"),
        {"requested_uri": "spotify:track:gone"},
    ]
    put(folder, "in/1.json", "\n".join(map(json.dumps, lines)))
    table, rejects = f"{folder}/tracks", f"{folder}/rejects"
    for _ in range(2):
        ingest.ingest_tracks(spark, f"{folder}/in", table, rejects)
    stored = read_table(spark, table)
    check_constraints(stored, not_null=["source_uri"], key=["source_uri"])
    assert [r[0] for r in rows(stored, "source_uri")] == [
        "https://open.spotify.com/track/d?si=1",
        "spotify:track:a", "spotify:track:b", "spotify:track:c",
    ]
    assert rows(stored.where("source_uri like '%b'").drop("artists")) == [
        ("spotify:track:b", "N", 1000, True, 7, "Al", "1999", "year", "al")
    ]
    assert [r.requested_uri for r in read_table(spark, rejects).collect()] == [
        "spotify:track:gone"
    ]
    wide = widen_artists(stored)
    assert artist_columns(wide) == 24 // 2
    c = wide.where("source_uri like '%:c'").first()
    assert (c.artist_1_name, c.artist_12_uri) == ("n1", "u12")
    a = wide.where("source_uri like '%:a'").first()
    assert a.artist_1_name is None
    assert stored.agg(artists_needed()).first()[0] == 12
    assert stored.where("size(artists) < 2").agg(artists_needed(existing=3)).first()[0] == 3


def test_track_rows_rejects_failed_lookups(spark):
    df = spark.createDataFrame(
        [("u", None, None), (None, 5, None), ("v", 5, None)],
        "uri string, duration_ms bigint, artists array<struct<name:string,uri:string>>",
    )
    for column, kind in (("name", "string"), ("is_playable", "boolean"), ("popularity", "int"),
                         ("album", "struct<name:string,release_date:string,"
                                   "release_date_precision:string,uri:string>")):  # fmt: skip
        df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS {column}")
    good, bad = track_rows(df)
    assert rows(good, "source_uri", "artists") == [("v", [])]
    assert bad.count() == 2


def test_uris_to_enrich(spark):
    links = ["spotify:track:x", "https://open.spotify.com/track/y?si=1", "spotify:episode:z", "", None]
    history = spark.createDataFrame([(u,) for u in links], "spotify_track_uri string")
    recent = spark.createDataFrame([("spotify:track:known",), ("spotify:track:x",)], history.schema)
    tracks = spark.createDataFrame([("spotify:track:known",)], "source_uri string")
    link, track = ("https://open.spotify.com/track/y?si=1", "y"), ("spotify:track:x", "x")
    assert rows(uris_to_enrich(history, recent, tracks)) == [link, track]
    # What is no track, or was rejected before, takes no place under the cap.
    assert rows(uris_to_enrich(history, recent, tracks, cap=1)) == [link]
    failed = spark.createDataFrame([(link[0], None)], "requested_uri string, uri string")
    assert rows(uris_to_enrich(history, recent, tracks, cap=1, rejects=failed)) == [track]
    everything = spark.createDataFrame([(u,) for u in links if u], "uri string")
    assert split_by_track_id(everything)[0].count() == 2


def test_unique_tracks(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "source_uri string, n int")
    assert rows(unique_tracks(df)) == [("a", 1), ("b", 3)]
    with pytest.raises(Exception, match="duplicate track a"):
        unique_tracks(df, on_dup="fail").collect()


def test_tables(spark, folder):
    path = f"{folder}/t"
    assert read_or_empty(spark, path, schemas.TAG_MAPPING).count() == 0
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "bb")], schemas.TAG_MAPPING)
    write_table(df, path, "fail")
    # A table may be replaced by something read from it.
    overwrite(read_table(spark, path).dropDuplicates(), path)
    assert read_table(spark, path).count() == 2
    failing = df.selectExpr("tag_id", "CAST(raise_error('no') AS string) AS spotify_track_uri")
    with pytest.raises(Exception, match="no"):
        overwrite(failing, path)
    assert read_table(spark, path).count() == 2
    with pytest.raises(ValueError, match="tag_id not null: 1"):
        overwrite(df, path, not_null=["tag_id"])
    with pytest.raises(ValueError, match="unique"):
        overwrite(df, path, key=["tag_id"])
    assert read_table(spark, path).count() == 2
    broken = constraint_violations(
        df, not_null=["tag_id"], key=["tag_id", "spotify_track_uri"], max_length={"spotify_track_uri": 1}
    )
    assert rows(broken) == [
        ("spotify_track_uri length <= 1", 1),
        ("tag_id not null", 1),
        ("unique (tag_id, spotify_track_uri)", 1),
    ]
    with pytest.raises(ValueError, match="tag_id not null: 1"):
        check_constraints(df, not_null=["tag_id"])


def test_pipeline_from_files(spark, folder):
    import golden
    from pyspark.sql import functions as F

    tables = Tables(folder)
    golden.history(spark).write.json(f"{folder}/export")
    ingest.ingest_history(spark, f"{folder}/export", tables.path("raw_extended_history"))
    golden.recent(spark).write.parquet(tables.path("raw_recently_played"))
    golden.tracks(spark).write.parquet(tables.path("track_data"))
    for _ in range(2):  # rebuilding replaces
        summary = rebuild_plays(spark, tables)
        assert summary.agg(F.sum("n")).first()[0] == 26
        stats = rebuild_track_stats(spark, tables)
        assert stats.count() == 5
    plays = read_table(spark, tables.path("plays"))
    assert set(plays.columns) == {"play_id", *schemas.PLAY_COLUMNS}
    recent_only = plays.where("source = 'recently_played'")
    scan = recent_only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in scan


def test_an_empty_log(spark, folder):
    tables = Tables(folder)
    for name, schema in (("raw_extended_history", schemas.HISTORY), ("raw_recently_played", schemas.RECENT), ("track_data", schemas.TRACK_DATA)):
        with pytest.raises(FileNotFoundError, match="no table"):
            rebuild_plays(spark, tables)
        spark.createDataFrame([], schema).write.parquet(tables.path(name))
    assert rows(rebuild_plays(spark, tables)) == []


def test_a_missing_input_leaves_the_old_table(spark, folder):
    import golden

    tables = Tables(folder)
    golden.history(spark).write.parquet(tables.path("raw_extended_history"))
    golden.recent(spark).write.parquet(tables.path("raw_recently_played"))
    golden.tracks(spark).write.parquet(tables.path("track_data"))
    rebuild_plays(spark, tables)
    before = read_table(spark, tables.path("plays")).count()
    Path(tables.path("raw_recently_played")).rename(f"{folder}/elsewhere")
    with pytest.raises(FileNotFoundError):
        rebuild_plays(spark, tables)
    assert read_table(spark, tables.path("plays")).count() == before
    # A swap that broke off between its renames is undone by the next reader.
    Path(tables.path("plays")).rename(f"{tables.path('plays')}.retired-1")
    assert rebuild_track_stats(spark, tables).count() == 5
    assert read_table(spark, tables.path("plays")).count() == before


def test_time_without_a_zone_is_utc(spark):
    from pyspark.sql import functions as F

    from earshot.functions.times import instant

    texts = ["2024-01-02T03:00:00Z", "2024-01-02T03:00:00", "2024-01-02 03:00:00.5", "2024-01-02T03:00:00+02:00", "2024-01-02", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = []
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found.append([r[0] for r in df.select(F.unix_micros(instant(F.col("t")))).collect()])
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    hour = 3_600_000_000
    three = 1_704_164_400_000_000
    assert found[0] == found[1] == [three, three, three + 500_000, three - 2 * hour, three - 3 * hour, None, None]


def test_known_pages_are_not_read_again(spark, folder):
    times = [f"2024-06-01T14:0{i}:00Z" for i in range(5)]
    land = lambda name, *played: put(folder, f"in/{name}", "\n".join(page([item(t, "A", "spotify:track:a")]) for t in played))
    recent, calls = f"{folder}/recent", f"{folder}/calls"
    unread = lambda: [
        path.rsplit("/", 1)[1] for path in unread_files(spark, f"{folder}/in", read_or_empty(spark, calls, schemas.RECENT_CALLS))
    ]
    load = lambda: ingest.ingest_recent(spark, f"{folder}/in", recent, calls)
    land("1 [a].json", times[0], times[1])
    land("2.json", times[2])
    assert unread() == ["1 [a].json", "2.json"]
    assert load() == {"pages": 3, "plays": 3, "added": 3}
    assert unread() == [] and load() == {"pages": 0, "plays": 0, "added": 0}
    land("3 {b}*.json", times[3])
    assert unread() == ["3 {b}*.json"]
    assert load() == {"pages": 1, "plays": 1, "added": 1}
    land("2.json", times[2], times[4])
    os.utime(f"{folder}/in/2.json", (2e9, 2e9))
    assert unread() == ["2.json"]
    assert load() == {"pages": 1, "plays": 1, "added": 1}
    assert unread() == []
    assert read_table(spark, recent).count() == 5 and read_table(spark, calls).count() == 5
