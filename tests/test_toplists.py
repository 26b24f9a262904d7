"""Top lists from sketches against counting every track."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from earshot.functions.times import month_of
from earshot.plans.toplists import candidates, daily_states, exact_top, month_of_day

SCHEMA = "spotify_track_uri string, played_at timestamp_ntz"


def logged(spark, plays):
    return spark.createDataFrame([(u, datetime(2024, 1, 1) + timedelta(hours=h)) for u, h in plays], SCHEMA)


def counted(plays, rows):
    counts = defaultdict(Counter)
    for uri, hours in plays:
        if uri:
            at = datetime(2024, 1, 1) + timedelta(hours=hours)
            counts[f"{at:%Y-%m}"][uri] += 1
            counts["all"][uri] += 1
    return {
        (group, rank, uri, n)
        for group, tracks in counts.items()
        for rank, (uri, n) in enumerate(sorted(tracks.items(), key=lambda x: (-x[1], x[0]))[:rows], 1)
    }


def log(kind):
    rng = random.Random(kind)
    hours = lambda: rng.randrange(24 * 80)
    if kind == "hot":
        return [("hot" if rng.random() < 0.34 else f"t{int(rng.paretovariate(0.8)) % 900}", hours()) for _ in range(6000)]
    if kind == "flat":
        return [(f"t{i % 700}", hours()) for i in range(4200)]
    if kind == "few":
        return [(f"t{rng.randrange(4)}", hours()) for _ in range(60)] + [(None, 3), ("", 4)]
    return [(f"t{i % 500}" if h < 24 * 31 else f"u{i % 3}", h) for i, h in ((i, hours()) for i in range(4000))]


@pytest.mark.parametrize("kind", ["hot", "flat", "few", "one flat month"])
@pytest.mark.parametrize("tracked", [16, 4096])
def test_equals_counting_all(spark, kind, tracked):
    played = log(kind)
    plays = logged(spark, played)
    states = daily_states(plays, tracked)
    whole = exact_top(plays, states, rows=7, tracked=tracked)
    months = exact_top(plays, states, month_of(F.col("played_at")), month_of_day(), rows=7, tracked=tracked)
    assert {tuple(r) for r in whole.unionByName(months).collect()} == counted(played, 7)


def test_only_few_tracks_are_candidates(spark):
    states = daily_states(logged(spark, log("hot")), 128)
    assert candidates(states, F.lit("all"), 128).count() <= 128
    assert states.count() == 80


def test_empty_log_and_rows_beyond_the_sketch(spark):
    plays = logged(spark, [])
    assert exact_top(plays, daily_states(plays)).collect() == []
    with pytest.raises(ValueError):
        exact_top(plays, daily_states(plays, 16), rows=17, tracked=16)
