"""Operators against brute force on data where one key, second or log dominates."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators.overlap import without_overlap
from earshot.operators.timeline import gap_to_next, sessions
from earshot.plans import plays as P
from earshot.plans import stats as S

START = datetime(2024, 2, 27, 23, 0)
SCHEMA = "user_id bigint, track_name string, played_at timestamp_ntz, spotify_track_uri string"


def skewed_log(seed, size=600):
    """Distinct plays: a third in one second, a third of one track, users with NULL."""
    rng = random.Random(seed)
    plays = set()
    while len(plays) < size:
        kind = rng.random()
        hot_second, hot_track = kind < 0.33, 0.33 <= kind < 0.66
        second = 5000 if hot_second else rng.choice([rng.randrange(4 * 86400), rng.randrange(3600)])
        track = 0 if hot_track else rng.randrange(400)
        user = rng.choice([None, 1, 1, 1, 2])
        plays.add((user, f"n{rng.randrange(3)}", START + timedelta(seconds=second), f"t:{track}"))
    return sorted(plays, key=str)


def brute_gaps(log, by_user):
    logs = defaultdict(list)
    for play in log:
        logs[play[0] if by_user else 0].append(play)
    result = []
    for plays in logs.values():
        plays.sort(key=lambda p: (p[2], p[3], p[1], -1 if p[0] is None else p[0]))
        for this, following in zip(plays, [*plays[1:], None]):
            gap = following and int((following[2] - this[2]).total_seconds())
            result.append((*this, gap))
    return Counter(result)


@pytest.mark.parametrize("by_user", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gap_to_next_equals_brute_force(spark, seed, by_user):
    log = skewed_log(seed)
    tiebreak = ["spotify_track_uri", "track_name"]
    found = gap_to_next(
        spark.createDataFrame(log, SCHEMA),
        "played_at",
        tiebreak if by_user else [*tiebreak, "user_id"],
        ["user_id"] if by_user else [],
    )
    assert Counter(tuple(r) for r in found.collect()) == brute_gaps(log, by_user)


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("gap", [0, 60, 300, 90000])
@pytest.mark.parametrize("by_user", [False, True])
def test_sessions_equal_brute_force(spark, seed, gap, by_user):
    log = skewed_log(seed)
    logs = defaultdict(list)
    for play in log:
        logs[play[0] if by_user else 0].append(play[2])
    expected = []
    for user, times in logs.items():
        run = []
        for time in [*sorted(times), None]:
            if run and (time is None or (time - run[-1]).total_seconds() > gap):
                expected.append((*([user] if by_user else []), run[0], run[-1], len(run)))
                run = []
            run.append(time)
    df = spark.createDataFrame(log, SCHEMA)
    found = sessions(df, "played_at", gap, ["user_id"] if by_user else [])
    assert Counter(tuple(r) for r in found.collect()) == Counter(expected)


@pytest.mark.parametrize("tolerance", [0, 1, 60, 4000])
@pytest.mark.parametrize("seed", [6, 7])
def test_without_overlap_equals_brute_force(spark, seed, tolerance):
    left, right = skewed_log(seed, 400), skewed_log(seed + 100, 60)
    times = defaultdict(list)
    for _, _, time, track in right:
        times[track].append(time)

    def close(play):
        return any(abs((play[2] - t).total_seconds()) <= tolerance for t in times[play[3]])

    frames = [spark.createDataFrame(x, SCHEMA) for x in (left, right)]
    kept = without_overlap(*frames, tolerance)
    assert Counter(tuple(r) for r in kept.collect()) == Counter(p for p in left if not close(p))
    overlapping = without_overlap(*frames, tolerance, keep="left_semi")
    assert Counter(tuple(r) for r in overlapping.collect()) == Counter(filter(close, left))


def _generated_plays(spark, n=20000):
    """History events, a third of them of one track, and track durations."""
    history = spark.range(n).select(
        F.concat(
            F.lit("spotify:track:"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("string"),
        ).alias("spotify_track_uri"),
        F.date_format(
            F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 97), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ).alias("ts"),
        (F.col("id") * 7919 % 250_000).alias("ms_played"),
        F.lit("clickrow").alias("reason_start"),
        F.when(F.col("id") % 4 == 0, "fwdbtn").alias("reason_end"),
    )
    tracks = spark.range(400).select(
        F.concat(F.lit("spotify:track:"), F.col("id").cast("string")).alias("source_uri"),
        F.concat(F.lit("song "), F.col("id").cast("string")).alias("track_name"),
        ((F.col("id") % 5) * 50_000).alias("duration_ms"),
        F.lit("someone").alias("artist_1_name"),
    )
    return history, tracks


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def test_a_hot_track_is_split_in_the_join_with_durations(spark, folder):
    history, tracks = _generated_plays(spark, 200_000)
    expected = rows(P.plays_summary(P.classify_history(history, tracks)))
    history.repartition(8).write.parquet(f"{folder}/history")
    before = {key: spark.conf.get(key, None) for key in SPLIT_EARLY}
    try:
        for key, value in SPLIT_EARLY.items():
            spark.conf.set(key, value)
        classified = P.classify_history(spark.read.parquet(f"{folder}/history"), tracks)
        summary = P.plays_summary(classified)
        assert rows(summary) == expected
        plan = summary._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan


def test_a_hot_second_is_split_in_the_join_with_the_seconds(spark, folder):
    second = F.when(F.col("id") % 3 == 0, 500_000).otherwise(F.col("id") * 5)
    log = spark.range(150_000).select(
        F.concat(F.lit("t:"), F.col("id").cast("string")).alias("spotify_track_uri"),
        F.lit("n").alias("track_name"),
        F.timestamp_seconds(second).cast("timestamp_ntz").alias("played_at"),
    )
    log.repartition(8).write.parquet(f"{folder}/log")
    before = {key: spark.conf.get(key, None) for key in SPLIT_EARLY}
    try:
        for key, value in SPLIT_EARLY.items():
            spark.conf.set(key, value)
        gaps = gap_to_next(
            spark.read.parquet(f"{folder}/log"), "played_at", ["spotify_track_uri", "track_name"],
            distinct=True,
        )
        total = gaps.agg(
            F.count("*"), F.count("gap_seconds"), F.sum("gap_seconds"), F.count_if(F.col("gap_seconds") == 0)
        )
        found = total.collect()[0]
        plan = total._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan
    # The gaps add up to the span of the log. The hot second holds 50,001 plays, as that of
    # id 100,000 falls into it too, and all but its last have a gap of zero.
    assert tuple(found) == (150_000, 149_999, 149_999 * 5 - 5, 50_000)


def test_track_stats_with_a_hot_track(spark):
    history, tracks = _generated_plays(spark)
    plays = P.classify_history(history, tracks).cache()
    as_of = F.lit("2024-06-01").cast("date")
    stats = S.track_stats(plays, tracks, as_of)
    quality = F.col("play_quality")
    plain = plays.groupBy("spotify_track_uri").agg(
        F.count("*").alias("play_count"),
        F.count_distinct(F.to_date("played_at")).alias("unique_days_played"),
        F.sum((quality == "skip").cast("int")).alias("skip_count"),
        F.avg("play_percentage").cast("decimal(5,4)").alias("avg_play_percentage"),
        F.sum("ms_played").alias("total_ms_played"),
        F.min("played_at").alias("first_played_at"),
        F.max("played_at").alias("last_played_at"),
    )
    assert rows(stats.select(plain.columns)) == rows(plain)
    peaks = S.peak_months(plays)
    assert rows(peaks) == rows(S.peak_months_ranked(plays))
    assert rows(
        stats.select("spotify_track_uri", "peak_listen_month", "peak_month_play_count")
    ) == rows(peaks)
    parts = ["full_listen", "natural_end", "partial", "skip", "unclassified"]
    total = sum((F.col(f"{p}_count") for p in parts), F.lit(0))
    assert stats.where(total != F.col("play_count")).count() == 0
    assert stats.where("skip_rate + completion_rate > 1").count() == 0
