from datetime import date
from decimal import Decimal

import golden
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators.timeline import gap_to_next
from earshot.plans import plays as P
from earshot.sources.tables import with_play_id
from earshot.plans import stats as S

key = lambda r: tuple((v is not None, str(v)) for v in r)


def all_plays(spark):
    return P.build_plays(golden.history(spark), golden.recent(spark), golden.tracks(spark))


def test_classify_history(spark):
    found = rows(P.classify_history(golden.history(spark), golden.tracks(spark)))
    assert found == sorted(golden.expected_history(), key=key)


def test_history_in_another_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = rows(P.classify_history(golden.history(spark), golden.tracks(spark)))
        plays = rows(all_plays(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == sorted(golden.expected_history(), key=key)
    assert plays == rows(all_plays(spark))


def test_gaps(spark):
    found = gap_to_next(golden.recent(spark), "played_at", ["spotify_track_uri", "track_name"])
    gaps = [r.gap_seconds for r in found.orderBy("played_at").collect()]
    assert gaps == [gap for _, _, gap, *_ in golden.RECENT]


def test_classify_recent(spark):
    found = rows(P.classify_recent(golden.recent(spark), golden.tracks(spark)))
    assert found == sorted(golden.expected_recent(False), key=key)


def test_copies_of_recent_plays_do_not_change_the_result(spark):
    log = golden.recent(spark)
    found = rows(P.classify_recent(log.union(log), golden.tracks(spark)))
    assert found == sorted(golden.expected_recent(False), key=key)


def test_build_plays(spark):
    expected = golden.expected_history() + golden.expected_recent(True)
    assert rows(all_plays(spark)) == sorted(expected, key=key)


def test_play_ids_are_unique(spark):
    keyed = with_play_id(all_plays(spark))
    assert keyed.select("play_id").distinct().count() == keyed.count() == 26


def test_plays_summary(spark):
    assert [tuple(r) for r in P.plays_summary(all_plays(spark)).collect()] == [
        ("extended_history", "full_listen", 4),
        ("extended_history", "natural_end", 4),
        ("extended_history", "partial", 3),
        ("extended_history", "skip", 6),
        ("recently_played", None, 3),
        ("recently_played", "full_listen", 3),
        ("recently_played", "natural_end", 2),
        ("recently_played", "partial", 1),
    ]


def test_track_stats(spark):
    as_of = F.lit(date(2024, 12, 1))
    stats = S.track_stats(all_plays(spark), golden.tracks(spark), as_of)
    found = {r.spotify_track_uri[-1]: r for r in stats.collect()}
    columns = stats.columns[3:10]
    assert {t: tuple(r[c] for c in columns) for t, r in found.items()} == {
        "A": (10, 4, 4, 3, 1, 2, 0),
        "B": (11, 4, 3, 2, 1, 4, 1),
        "L": (1, 1, 0, 1, 0, 0, 0),
        "N": (2, 2, 0, 0, 1, 0, 1),
        "Z": (2, 2, 0, 0, 1, 0, 1),
    }
    measures = ["avg_play_percentage", "total_ms_played", "total_minutes_played", "skip_rate",
                "completion_rate"]
    d = Decimal
    assert {t: tuple(r[c] for c in measures) for t, r in found.items()} == {
        "A": (d("0.4815"), 763019, d("12.72"), d("0.2857"), d("0.5714")),
        "B": (d("0.3904"), 371332, d("6.19"), d("0.5000"), d("0.3750")),
        "L": (d("0.9000"), None, None, None, None),
        "N": (None, 40000, d("0.67"), d("0.0000"), d("0.0000")),
        "Z": (None, 500000, d("8.33"), d("0.0000"), d("0.0000")),
    }
    times = ["first_played_at", "last_played_at", "days_since_last", "peak_listen_month",
             "peak_month_play_count", "track_name", "artist_name"]
    at = golden.at
    assert {t: tuple(r[c] for c in times) for t, r in found.items()} == {
        "A": (at("2024-01-01 22:00:00"), at("2024-06-01 10:22:01"), 183, "2024-06", 4, "Song A", "Art A"),
        "B": (at("2024-01-03 19:00:00"), at("2024-11-03 01:30:00"), 28, "2024-01", 5, "Song B", "Art B"),
        "L": (at("2024-06-01 10:04:29"), at("2024-06-01 10:04:29"), 183, "2024-06", 1, "Long", "Art L"),
        "N": (at("2024-01-02 00:00:00"), at("2024-06-01 10:10:29"), 183, "2024-06", 1, None, None),
        "Z": (at("2024-01-04 02:00:00"), at("2024-06-01 10:11:00"), 183, "2024-06", 1, "Song Z", "Art Z"),
    }


def test_reports(spark):
    stats = S.track_stats(all_plays(spark), golden.tracks(spark), F.lit(date(2024, 12, 1))).cache()
    d = Decimal
    assert rows(S.stats_summary(stats)) == [(5, 26, d("5.20"), 11, d("0.1964"), d("0.2366"))]
    top = [r.track_name for r in S.top_played(stats).collect()]
    assert top == ["Song B", "Song A", "", "Song Z", "Long"]
    skipped = [(r.track_name, r.skip_rate) for r in S.most_skipped(stats).collect()]
    assert skipped == [("Song B", d("0.500")), ("Song A", d("0.286"))]


def test_unusable_ts(spark):
    import pytest

    bad = golden.history(spark).withColumn(
        "ts", F.when(F.col("ms_played") == 199000, "soon").otherwise(F.col("ts"))
    )
    with pytest.raises(Exception, match="unusable ts"):
        P.classify_history(bad, golden.tracks(spark)).collect()
    assert P.classify_history(bad, golden.tracks(spark), on_bad="skip").count() == 16
    assert [r.ts for r in P.unparsed_history(bad).collect()] == ["soon"]
