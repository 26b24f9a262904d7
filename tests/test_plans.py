"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from earshot.workload.queries import REGISTRY
from earshot import schemas
from earshot.plans import plays as P
from earshot.plans import stats as S

SF = "/root/testdata/sf0.001"
WRITING = re.compile("ingest|pages|files|stream|pipeline|recent_calls")
BATCH = [name for name in REGISTRY if not WRITING.search(name)]


@pytest.fixture
def tables(spark, folder):
    """Empty stored tables, with broadcasts off, so that plans show their shuffles."""
    paths = {}
    for name, schema in {
        "history": schemas.HISTORY,
        "recent": schemas.RECENT,
        "tracks": schemas.TRACK_DATA,
        "plays": schemas.PLAYS,
    }.items():
        paths[name] = f"{folder}/{name}"
        spark.createDataFrame([], schema).write.parquet(paths[name])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: spark.read.parquet(path) for name, path in paths.items()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return [re.search(r"ReadSchema: struct<(.*?)>$", x, re.M).group(1) for x in formatted(plan)]


def formatted(df):
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return [part for part in text.split("\n\n") if "ReadSchema" in part]


@pytest.mark.parametrize("name", BATCH)
def test_batch_queries_stay_in_the_engine(spark, name):
    plan = plan_of(REGISTRY[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan


def test_gaps_never_gather_the_plays(spark, tables):
    plan = plan_of(P.classify_recent(tables["recent"], tables["tracks"]))
    assert plan.count("Exchange SinglePartition") == 1
    # What is gathered is the aggregation by day.
    below = plan.split("Exchange SinglePartition")[1].splitlines()[1]
    assert "HashAggregate" in below and "min(" in below


def test_gaps_of_several_logs_gather_nothing(spark, tables):
    recent = tables["recent"].withColumn("user_id", F.length("track_name"))
    plan = plan_of(P.classify_recent(recent, tables["tracks"], partition_cols=["user_id"]))
    assert "SinglePartition" not in plan


def test_overlap_is_a_hash_partitioned_anti_join(spark, tables):
    events = P.history_events(tables["history"])
    plan = plan_of(P.dedup_recent(tables["plays"], events))
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert re.search(r"SortMergeJoin \[spotify_track_uri#\d+, _slot#\d+L?\]", plan)


def test_only_needed_columns_are_read(spark, tables):
    classified = P.classify_history(tables["history"], tables["tracks"])
    read = sorted(scans(classified), key=len)
    assert read[0] == "source_uri:string,duration_ms:bigint"
    assert set(re.findall(r"(\w+):", read[1])) == {
        "ts", "ms_played", "spotify_track_uri", "reason_start", "reason_end",
    }
    peaks = scans(S.peak_months(tables["plays"]))
    assert peaks == ["spotify_track_uri:string,played_at:timestamp_ntz"]


def test_filters_reach_the_scan(spark, tables):
    (scan,) = formatted(P.credible(tables["history"]))
    assert "IsNotNull(spotify_track_uri)" in scan
    assert "Not(EqualTo(spotify_track_uri,))" in scan


def test_track_stats_shuffles_plays_once(spark, tables):
    stats = S.track_stats(tables["plays"], tables["tracks"])
    plan = plan_of(stats)
    # By track and day, the day rows by track, and the track names; no shuffle between
    # months and tracks.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3
    assert "SortAggregate" not in plan


def test_monthly_report_prunes_before_the_shuffle(spark):
    plan = plan_of(REGISTRY["monthly_most_played"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan
