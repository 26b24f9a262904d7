import json
from pathlib import Path

import golden
from conftest import rows
from pyspark.sql import functions as F

from earshot import schemas
from earshot.plans import plays as P
from earshot.streaming import classify as SC
from earshot.streaming import recent as SR


def land(folder, name, plays, cursors=None):
    """One page of (utc time, track) plays."""
    Path(folder).mkdir(exist_ok=True)
    items = [
        {"played_at": f"2024-06-01T{time}Z", "track": {"name": f"name {t}", "uri": golden.URIS[t]}}
        for time, t in plays
    ]
    page = {"items": items, "cursors": cursors or {}}
    (Path(folder) / name).write_text(json.dumps(page))


# The golden recent plays in UTC, in two polls that overlap.
PLAYS = [(f"{int(time[:2]) + 4}{time[2:]}", t) for t, time, *_ in golden.RECENT]
POLLS = [PLAYS[:6], PLAYS[4:]]


def test_dedup_by_state(spark, folder):
    pages, table, marks = (f"{folder}/{x}" for x in ("pages", "table", "marks"))
    for i, poll in enumerate(POLLS):
        land(pages, f"{i}.json", poll)
        stream = SR.distinct_recent(SR.page_stream(spark, pages))
        SR.stream_table(stream, table, marks).awaitTermination()
    assert rows(spark.read.parquet(table)) == rows(golden.recent(spark))


def test_exact_ingest_and_audit(spark, folder):
    pages, table, calls, marks = (f"{folder}/{x}" for x in ("pages", "table", "calls", "marks"))
    for i, poll in enumerate([*POLLS, POLLS[0]]):
        land(pages, f"{i}.json", poll, {"before": str(i)})
        query = SR.start_recent_ingest(SR.page_stream(spark, pages), table, calls, marks)
        query.awaitTermination()
    assert rows(spark.read.parquet(table)) == rows(golden.recent(spark))
    assert rows(spark.read.parquet(calls), "before_ts", "after_ts") == [(0, 0), (1, 0), (2, 0)]


def run_classification(spark, landing, output, marks, tracks):
    stream = spark.readStream.schema(schemas.RECENT).parquet(landing)
    SC.start_classification(stream, tracks, output, marks).awaitTermination()


def test_classification_as_plays_arrive(spark, folder):
    landing, output, marks = (f"{folder}/{x}" for x in ("landing", "output", "marks"))
    recent, tracks = golden.recent(spark), golden.tracks(spark)
    cut = F.lit("2024-06-01 10:04:29").cast("timestamp_ntz")
    recent.where(F.col("played_at") <= cut).write.parquet(landing)
    run_classification(spark, landing, output, marks, tracks)
    assert spark.read.parquet(f"{output}/plays").count() == 4
    assert rows(spark.read.parquet(f"{output}/open/batch_id=0"), "spotify_track_uri") == [(golden.L,)]

    recent.where(F.col("played_at") > cut).write.mode("append").parquet(landing)
    run_classification(spark, landing, output, marks, tracks)
    found = SC.classified_so_far(spark, output, tracks, 1)
    assert rows(found) == rows(P.classify_recent(recent, tracks))

    # A play from before the open one is set aside.
    recent.where(F.col("played_at") <= cut).limit(1).write.mode("append").parquet(landing)
    run_classification(spark, landing, output, marks, tracks)
    assert spark.read.schema(schemas.RECENT).parquet(f"{output}/late").count() == 1
    again = SC.classified_so_far(spark, output, tracks, 2)
    assert rows(again) == rows(P.classify_recent(recent, tracks))


def test_classification_per_user(spark, folder):
    landing, output, marks = (f"{folder}/{x}" for x in ("landing", "output", "marks"))
    tracks = golden.tracks(spark)
    user = F.when(F.col("spotify_track_uri") != golden.A, F.length("track_name")).cast("bigint")
    log = golden.recent(spark).withColumn("user_id", user)
    halves = [F.col("played_at") <= F.lit("2024-06-01 10:11:00").cast("timestamp_ntz")]
    halves.append(~halves[0])
    for half in halves:
        log.where(half).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(log.schema).parquet(landing)
        SC.start_classification(
            stream, tracks, output, marks, partition_cols=["user_id"]
        ).awaitTermination()
    found = SC.classified_so_far(spark, output, tracks, 1, ["user_id"])
    expected = P.classify_recent(log, tracks, partition_cols=["user_id"])
    assert rows(found) == rows(expected)
    assert expected.where("user_id is null").count() == 4


def test_overlap_with_static_history(spark, folder):
    landing, table, marks = (f"{folder}/{x}" for x in ("landing", "table", "marks"))
    golden.recent(spark).write.parquet(landing)
    stream = spark.readStream.schema(schemas.RECENT).parquet(landing)
    kept = SC.stream_without_overlap(stream, P.history_events(golden.history(spark)))
    SR.stream_table(kept, table, marks).awaitTermination()
    expected = [f"10:{m}" for m in ("00:00", "03:09", "04:29", "10:29", "11:00", "12:00", "17:00", "22:01", "24:00")]
    found = spark.read.parquet(table).select(F.date_format("played_at", "HH:mm:ss"))
    assert [r[0] for r in rows(found)] == expected


def test_overlap_in_batches(spark, folder):
    landing, output, marks = (f"{folder}/{x}" for x in ("landing", "output", "marks"))
    recent, events = golden.recent(spark), P.history_events(golden.history(spark))
    cut = F.lit("2024-06-01 10:02:45").cast("timestamp_ntz")
    for part in (F.col("played_at") <= cut, F.col("played_at") > cut):
        recent.where(part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schemas.RECENT).parquet(landing)
        SC.start_overlap_check(stream, events, output, marks).awaitTermination()
    found = spark.read.schema(schemas.RECENT).parquet(output).drop("batch_id")
    assert rows(found) == rows(P.dedup_recent(recent, events))


def test_session_windows(spark, folder):
    landing, table, marks = (f"{folder}/{x}" for x in ("landing", "table", "marks"))
    times = ["10:00:00", "10:05:00", "10:10:01", "11:00:00", "23:00:00"]
    plays = spark.createDataFrame([(f"2024-06-01 {t}",) for t in times], "t string")
    user = F.lit(1).cast("bigint").alias("user_id")
    plays.select(user, F.col("t").cast("timestamp").alias("at")).write.parquet(landing)
    stream = spark.readStream.schema("user_id bigint, at timestamp").parquet(landing)
    windows = SR.session_windows(stream, "at", 300, ["user_id"])
    SR.stream_table(windows, table, marks).awaitTermination()
    # 300 seconds belong together, 301 do not; the last session is still open.
    shown = spark.read.parquet(table).select(
        F.date_format("session_start", "HH:mm:ss"), F.date_format("session_end", "HH:mm:ss"), "play_count"
    )
    assert rows(shown) == [("10:00:00", "10:05:00", 2), ("10:10:01", "10:10:01", 1), ("11:00:00", "11:00:00", 1)]
