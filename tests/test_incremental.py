"""Rebuilding changed days only, and the ledger that tells which."""

from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.plans import incremental as I
from earshot.plans import plays as P
from earshot.plans import stats as S
from earshot.plans.ledger import Counter, Ledger
from earshot.plans.pipeline import Tables
from earshot.schemas import PLAY_COLUMNS
from earshot.sources import slots
from earshot.workload import views as V

SF = "/root/testdata/sf0.001"
DAY = date(2024, 2, 10)


def as_of():
    return F.lit("2024-06-01").cast("date")


@pytest.fixture
def base(spark, folder):
    tables = Tables(f"{folder}/tables")
    V.track_data(spark, SF).withColumns(
        {c: F.lit(None).cast("string") for c in ("release_date", "release_date_precision", "album_uri")}
    ).write.parquet(tables.path("track_data"))
    return tables, Ledger(spark, f"{folder}/ledger")


def raw(spark):
    history = V.history(spark, SF)
    local = F.to_date(P.local_time(P.to_instant(F.col("ts"))))
    return history.withColumn("_day", local), V.recent(spark, SF).drop("user_id").withColumn("_day", F.to_date("played_at"))


def land(spark, base, run, condition):
    history, recent = raw(spark)
    I.land_history(spark, *base, run, history.where(condition).drop("_day"))
    I.land_recent(spark, *base, run, recent.where(condition).drop("_day"))


def expected(spark, condition):
    history, recent = raw(spark)
    return P.build_plays(history.where(condition), recent.where(condition), V.track_data(spark, SF))


def check(spark, base, condition):
    plays = expected(spark, condition)
    assert rows(I.plays_by_day(spark, base[0]).select(*PLAY_COLUMNS)) == rows(plays)
    stats = S.track_stats(plays, V.track_data(spark, SF), as_of())
    assert rows(spark.read.parquet(base[0].path("track_stats")).select(*stats.columns)) == rows(stats)


def stamps(path):
    return {p.name: max(f.stat().st_mtime_ns for f in p.iterdir()) for p in Path(path).iterdir() if p.name.startswith("day=")}


def test_one_more_day_rewrites_it_and_its_neighbours(spark, base):
    tables, ledger = base
    but = F.col("_day") != DAY
    land(spark, base, "a", but)
    I.rebuild_changed_days(spark, tables, ledger, "a", as_of())
    check(spark, base, but)
    before = stamps(tables.path("plays_by_day"))

    land(spark, base, "b", F.col("_day") == DAY)
    written = I.rebuild_changed_days(spark, tables, ledger, "b", as_of())
    assert written == [date(2024, 2, 9), DAY, date(2024, 2, 11)]
    check(spark, base, F.lit(True))
    after = stamps(tables.path("plays_by_day"))
    assert {d for d in after if after[d] != before.get(d)} == {f"day={d}" for d in written}
    assert len(after) > 60
    # Nothing is new, so nothing is written.
    assert I.rebuild_changed_days(spark, tables, ledger, "c", as_of()) == []
    assert stamps(tables.path("plays_by_day")) == after


def test_a_landing_again_and_a_rebuild_that_broke_off(spark, base, monkeypatch):
    tables, ledger = base
    but = F.col("_day") != DAY
    land(spark, base, "a", but)
    I.rebuild_changed_days(spark, tables, ledger, "a", as_of())
    for _ in range(2):
        land(spark, base, "b", F.col("_day") == DAY)
    install, moved = slots.SlotChange.install, []

    def break_off(self):
        if not moved:
            moved.append(1)
            raise OSError("lost")
        install(self)

    monkeypatch.setattr(slots.SlotChange, "install", break_off)
    with pytest.raises(OSError):
        I.rebuild_changed_days(spark, tables, ledger, "b", as_of())
    I.rebuild_changed_days(spark, tables, ledger, "b", as_of())
    check(spark, base, F.lit(True))
    assert not list(Path(tables.base).glob("_*"))


def test_reads_only_the_days_it_needs(spark, base):
    tables, ledger = base
    land(spark, base, "a", F.lit(True))
    recent_days = I._folders(spark, tables.path("recent_by_day"))
    plays = I._plays_of(spark, tables, [DAY], recent_days, I.schemas.Thresholds())
    text = plays._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) >= 3 and all("day#" in f for f in filters)


def test_days_to_rebuild():
    days = [date(2024, 5, d) for d in (1, 2, 7, 8, 20)]
    assert I.days_to_rebuild([date(2024, 5, 8)], days) == [date(2024, 5, 7), date(2024, 5, 8)]
    assert I.days_to_rebuild([date(2024, 5, 5)], days) == [date(2024, 5, 2), date(2024, 5, 5)]
    assert I.days_to_rebuild([date(2024, 4, 30)], days) == [date(2024, 4, 30), date(2024, 5, 1)]
    assert I.days_to_rebuild([], days) == []


def test_ledger_counts_once(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")
    assert ledger.rows().count() == 0
    counter, ran = Counter(), []

    def job():
        ran.append(1)
        counter.watch("written", spark.range(7)).write.parquet(f"{folder}/seven")
        return counter.counts()

    assert ledger.once("seven", "r1", job) == {"written": 7}
    assert ledger.once("seven", "r1", job) == {"written": 7}
    assert ran == [1]
    ledger.record("other", "r1", {"a": 1, "b": 0}, [DAY])
    ledger.record("other", "r1", {"a": 2, "b": 0}, [DAY])
    assert rows(ledger.counted()) == [("other", "r1", "a", 2), ("other", "r1", "b", 0), ("seven", "r1", "written", 7)]
    assert ledger.pending(["other"], "user") == ({"other/r1"}, {DAY})
    ledger.record("user", "r2", {}, used=["other/r1"])
    assert ledger.pending(["other"], "user") == (set(), set())


def test_plays_of_a_rebuild_are_written_once(spark, base, monkeypatch):
    """Neither plays nor sums are kept beside their staged folders."""
    kept = []
    monkeypatch.setattr(slots.SlotChange, "keep", lambda self, df, name: kept.append(name) or df)
    land(spark, base, "a", F.lit(True))
    I.rebuild_changed_days(spark, *base, "a", as_of())
    check(spark, base, F.lit(True))
    assert kept == []
