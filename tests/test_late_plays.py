"""Streams that plays reach late and out of order."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import golden
import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot import schemas
from earshot.plans import plays as P
from earshot.sources import slots
from earshot.streaming import lossless as L
from earshot.streaming import repair as SR
from earshot.streaming import classify as SC
from earshot.streaming import recent as R
from earshot.workload import views as V

SF = "/root/testdata/sf0.001"


def split(df, n):
    """A frame dealt into n parts by a hash of its rows."""
    return [df.where(F.pmod(F.xxhash64(*df.columns), F.lit(n)) == i) for i in range(n)]


def deliver(spark, part, landing, tracks, output, marks, **more):
    part.write.mode("append").parquet(landing)
    stream = spark.readStream.schema(part.schema).parquet(landing)
    SR.start_repairing_classification(stream, tracks, output, marks, **more).awaitTermination()


@pytest.mark.parametrize("slot_seconds", [86_400, 1_000_000])
def test_shuffled_deliveries_give_the_batch_result(spark, folder, slot_seconds):
    landing, output, marks = (f"{folder}/{x}" for x in ("landing", "output", "marks"))
    recent, tracks = V.recent(spark, SF).drop("user_id"), V.track_data(spark, SF)
    for part in split(recent, 3):
        deliver(spark, part, landing, tracks, output, marks, slot_seconds=slot_seconds)
    assert rows(SR.classified_log(spark, output)) == rows(P.classify_recent(recent, tracks))


def test_several_logs_with_null_keys(spark, folder):
    landing, output, marks = (f"{folder}/{x}" for x in ("landing", "output", "marks"))
    user = F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 7).alias("user_id")
    recent, tracks = V.recent(spark, SF).withColumn("user_id", user), V.track_data(spark, SF)
    for part in reversed(split(recent, 3)):
        deliver(spark, part, landing, tracks, output, marks, partition_cols=["user_id"])
    found = SR.classified_log(spark, output, ["user_id bigint"])
    assert rows(found) == rows(P.classify_recent(recent, tracks, partition_cols=["user_id"]))


def test_a_late_play_rewrites_its_slot_and_the_one_before(spark, folder):
    tracks, output = golden.tracks(spark), f"{folder}/output"
    at = lambda day: [(f"n{day}", datetime(2024, 5, day, 12), golden.A)]
    days = spark.createDataFrame([r for d in (1, 2, 10, 11, 20) for r in at(d)], schemas.RECENT)
    number = {d: (datetime(2024, 5, d) - datetime(1970, 1, 1)).days for d in range(1, 31)}
    assert SR.repair(days, "a", tracks, output) == [number[d] for d in (1, 2, 10, 11, 20)]
    late = spark.createDataFrame(at(5), schemas.RECENT)
    assert SR.repair(late, "b", tracks, output) == [number[2], number[5]]
    assert SR.repair(late, "c", tracks, output) == [number[5]]  # known already: its slot is compared, nothing moves
    assert rows(SR.classified_log(spark, output)) == rows(P.classify_recent(days.unionByName(late), tracks))


def test_a_batch_that_broke_off_is_completed(spark, folder, monkeypatch):
    tracks, output = golden.tracks(spark), f"{folder}/output"
    recent = golden.recent(spark)
    first, second = split(recent, 2)
    SR.repair(first, "a", tracks, output)
    install = slots.SlotChange.install

    def break_off(self):
        raise OSError("lost")

    monkeypatch.setattr(slots.SlotChange, "install", break_off)
    with pytest.raises(OSError):
        SR.repair(second, "b", tracks, output)
    assert rows(SR.classified_log(spark, output)) == rows(P.classify_recent(first, tracks))
    monkeypatch.setattr(slots.SlotChange, "install", install)
    SR.repair(second, "b", tracks, output)
    assert rows(SR.classified_log(spark, output)) == rows(P.classify_recent(recent, tracks))
    assert not Path(f"{output}/_change-b").exists()


def land(folder, name, days, per_day=3):
    Path(folder).mkdir(exist_ok=True)
    items = [
        {"played_at": (datetime(2024, 5, 1, 9) + timedelta(days=d, minutes=i)).strftime("%Y-%m-%dT%H:%M:%SZ"), "track": {"name": f"t{i}", "uri": f"u{i}"}}
        for d in days
        for i in range(per_day)
    ]
    (Path(folder) / name).write_text(json.dumps({"items": items, "cursors": {}}))


def test_no_play_is_lost_behind_the_look_back(spark, folder):
    pages, output, marks = (f"{folder}/{x}" for x in ("pages", "output", "marks"))
    counts = []
    polls = [[40, 41], [41, 42, 1], [], [1, 2, 43], [42, 43, 2]]
    for i, days in enumerate(polls):
        land(pages, f"{i}.json", days)
        L.start_lossless_ingest(
            R.page_stream(spark, pages), output, marks, on_batch=lambda _, b, c: counts.append(c)
        ).awaitTermination()
    days = rows(L.ingested(spark, output).select(F.dayofyear("played_at") - 122).distinct())
    assert sorted(d for (d,) in days) == [1, 2, 40, 41, 42, 43]
    assert L.ingested(spark, output).count() == 18
    assert [(c["added"], c["added_late"]) for c in counts] == [(6, 0), (6, 3), (0, 0), (6, 3), (0, 0)]
    # The window keeps two days, whatever the table holds; the batch before last is gone.
    kept = sorted(p.name for p in Path(f"{output}/window").iterdir() if p.is_dir())
    assert kept == ["batch_id=3", "batch_id=4"]
    assert spark.read.parquet(f"{output}/window/batch_id=4").count() == 7


def test_a_batch_again_adds_nothing(spark, folder):
    pages, output = f"{folder}/pages", f"{folder}/output"
    land(pages, "a.json", [1, 2, 30])
    batch = spark.read.schema(schemas.RECENT_PAGE).json(pages)
    for batch_id in (0, 0, 1, 1):
        L.store_batch(batch, batch_id, output)
    assert L.ingested(spark, output).count() == 9


def test_late_plays_read_the_folders_of_their_days(spark, folder):
    """The filter of the second tier is one on folders, not on rows."""
    pages, output = f"{folder}/pages", f"{folder}/output"
    land(pages, "a.json", [1, 2, 30])
    L.store_batch(spark.read.schema(schemas.RECENT_PAGE).json(pages), 0, output)
    day = datetime(2024, 5, 2).date()
    plan = L._stored(spark, output).where(F.col("day").isin([day]) & (F.col("batch_id") < 1))
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    (filters,) = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert "day#" in filters and "batch_id#" in filters


def sessions_of(spark, landing, table, marks, plays):
    plays.write.mode("append").parquet(landing)
    stream = spark.readStream.schema("user_id bigint, at timestamp").parquet(landing)
    query = R.start_sessions(stream, "at", 300, ["user_id"], table, marks)
    query.awaitTermination()
    return query


def test_closed_sessions_leave_the_state(spark, folder):
    """One user has a third of all plays; what is kept are the sessions still open."""
    landing, table, marks = (f"{folder}/{x}" for x in ("landing", "table", "marks"))
    users = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).cast("bigint").alias("user_id")
    start = F.lit("2024-06-01").cast("timestamp")
    plays = spark.range(9000).select(users, F.timestamp_add("SECOND", F.col("id").cast("int") * 20, start).alias("at"))
    cut = F.timestamp_add("HOUR", F.lit(30), start)
    sessions_of(spark, landing, table, marks, plays.where(F.col("at") < cut))
    query = sessions_of(spark, landing, table, marks, plays.where(F.col("at") >= cut))
    (state,) = query.lastProgress["stateOperators"]
    assert "RocksDB" in json.dumps(state["customMetrics"]) or any("rocksdb" in k for k in state["customMetrics"])
    found = rows(spark.read.parquet(table))
    expected = rows(batch_sessions(plays, "1 hour"))
    # All users but the hot one play every 800 seconds or so: a session each time.
    assert found == expected and len(found) > 3000
    assert state["numRowsTotal"] < 200
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "HDFSBacked").find("HDFSBacked") >= 0


def batch_sessions(plays, delay):
    """Sessions that are over once all plays have come."""
    window = F.session_window("at", "300 seconds")
    last = plays.agg((F.max("at") - F.expr(f"interval {delay}")).alias("mark")).first().mark
    whole = plays.groupBy("user_id", window.alias("w")).agg(F.max("at").alias("session_end"), F.count("*").alias("play_count"))
    over = whole.where(F.timestamp_add("SECOND", F.lit(300), F.col("session_end")) <= F.lit(last))
    return over.select("user_id", F.col("w.start").alias("session_start"), "session_end", "play_count")


def test_overlap_of_two_streams(spark, folder):
    recent, events = golden.recent(spark), P.history_events(golden.history(spark))
    far = spark.createDataFrame([("end", datetime(2030, 1, 1), "end")], schemas.RECENT)
    folders = [f"{folder}/{x}" for x in ("recent", "history")]
    events = events.select("spotify_track_uri", "played_at")
    for i, df in enumerate((recent, events)):
        df.write.parquet(folders[i])
        far.select(*df.columns).write.mode("append").parquet(folders[i])
    streams = [spark.readStream.schema(d.schema).parquet(f) for d, f in zip((recent, events), folders)]
    kept = SC.stream_without_stream_overlap(*streams)
    R.stream_table(kept, f"{folder}/table", f"{folder}/marks").awaitTermination()
    assert rows(spark.read.schema(schemas.RECENT).parquet(f"{folder}/table")) == rows(P.dedup_recent(recent, events))


def test_overlap_looks_into_the_days_of_the_batch(spark, folder):
    landing, by_day, output, marks = (f"{folder}/{x}" for x in ("landing", "history", "output", "marks"))
    recent, events = V.recent(spark, SF).drop("user_id").distinct(), P.history_events(V.history(spark, SF))
    SC.write_history_by_day(events, by_day)
    one_day = recent.where("to_date(played_at) = '2024-02-10'")
    text = SC.near_history(one_day, by_day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day#" in text or "PartitionFilters: [day#" in text
    recent.write.parquet(landing)
    stream = spark.readStream.schema(schemas.RECENT).parquet(landing)
    SC.start_overlap_check_by_day(stream, by_day, output, marks).awaitTermination()
    found = spark.read.schema(schemas.RECENT).parquet(output).drop("batch_id")
    assert rows(found) == rows(P.dedup_recent(recent, events))
