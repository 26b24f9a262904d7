"""Rebuilding only the days that new raw rows can change.

The raw rows lie in folders by day and run, ``plays`` and the day sums of ``track_stats`` in folders by
day. A history play changes its day, and by the overlap check recent plays of the days beside it; a
recent play changes its day and the last recent play before it. Those days are written again, and the
statistics of the tracks that had or have plays in them are folded again from the day sums.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot import schemas
from earshot.plans import plays as P
from earshot.plans.ledger import Ledger
from earshot.plans.pipeline import Tables
from earshot.plans.stats import stats_of_days, track_days
from earshot.sources.history import exists, hadoop_path, remove
from earshot.sources.slots import SlotChange, read_slots
from earshot.sources.tables import TRACK_DATA_RULES, TRACK_STATS_RULES, check_constraints, overwrite, read_or_empty, read_required

URI = P.URI
HISTORY_DAYS = f"{URI} string, played_at timestamp_ntz, ms_played bigint, reason_start string, reason_end string, day date, run string"
RECENT_DAYS = f"{schemas.RECENT}, day date, run string"
PLAY_DAYS = schemas.PLAYS.replace("play_id bigint,", "").strip() + ", day date"
TRACK_DAYS = """
    spotify_track_uri string, plays bigint, full bigint, natural bigint, partial bigint, skip bigint, none bigint,
    share_sum decimal(15,4), share_n bigint, ms bigint, first timestamp_ntz, last timestamp_ntz, day date
"""
LANDING = ("land_history", "land_recent")
REBUILD = "rebuild_days"


def _land(df: DataFrame, path: str, run: str) -> list[date]:
    """Write a run's rows to their days; the same run again replaces them."""
    laid_out = df.withColumn("day", F.to_date("played_at")).withColumn("run", F.lit(run))
    laid_out.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "day", "run"
    ).parquet(path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in laid_out.schema)
    found = df.sparkSession.read.schema(schema).parquet(path).where(F.col("run") == run)
    return [r.day for r in found.select("day").distinct().collect()]


def land_history(
    spark: SparkSession, tables: Tables, ledger: Ledger, run: str, history: DataFrame, tz: str = schemas.HOME_TIMEZONE
) -> list[date]:
    """Add history rows: what the classification needs of the credible ones, their time parsed once."""
    events = P.history_events(history, tz).select(URI, "played_at", "ms_played", "reason_start", "reason_end")
    days = _land(events, tables.path("history_by_day"), run)
    ledger.record("land_history", run, {"days": len(days)}, days)
    return days


def land_recent(spark: SparkSession, tables: Tables, ledger: Ledger, run: str, recent: DataFrame) -> list[date]:
    """Add recent plays that no other run has added; only the folders of their days are read for that."""
    path, identity = tables.path("recent_by_day"), ["track_name", "played_at", URI]
    days = [r.day for r in recent.select(F.to_date("played_at").alias("day")).distinct().collect()]
    fresh = recent.select(*identity).dropDuplicates()
    stored = read_slots(spark, path, RECENT_DAYS, "day", days).where(F.col("run") != run).select(*identity)
    kept = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in identity]
    known = stored.select(*[F.col(c).alias(f"_{c}") for c in identity])
    days = _land(fresh.join(known, kept, "left_anti"), path, run)
    ledger.record("land_recent", run, {"days": len(days)}, days)
    return days


def _folders(spark: SparkSession, path: str) -> list[date]:
    """The days a table has, from the names of its folders."""
    if not exists(spark, path):
        return []
    fs, root = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(date.fromisoformat(n.removeprefix("day=")) for n in names if n.startswith("day=") and n[4:5].isdigit())


def days_to_rebuild(changed: Iterable[date], recent_days: list[date]) -> list[date]:
    """The changed days, the days with recent plays just before them, and those next to them."""
    one, found = timedelta(days=1), set(changed)
    for day in [*found]:
        before = bisect_left(recent_days, day)
        found.update(recent_days[max(0, before - 1) : before])
        found.update(d for d in (day - one, day + one) if d in recent_days)
    return sorted(found)


def _plays_of(spark: SparkSession, tables: Tables, days: list[date], recent_days: list[date], limits: schemas.Thresholds) -> DataFrame:
    """``plays`` of some days, with ``day``; reads these days and those that their gaps and overlaps reach."""
    one = timedelta(days=1)
    after = {recent_days[i] for d in days for i in [bisect_right(recent_days, d)] if i < len(recent_days)}
    around = {d + n * one for d in days for n in (-1, 0, 1)}
    tracks = read_required(spark, tables.path("track_data"), schemas.TRACK_DATA)
    check_constraints(tracks, **TRACK_DATA_RULES)
    history = read_slots(spark, tables.path("history_by_day"), HISTORY_DAYS, "day", around)
    recent = read_slots(spark, tables.path("recent_by_day"), RECENT_DAYS, "day", after.union(days))
    day = F.to_date("played_at")
    from_history = P.classify_events(history.where(F.col("day").isin(days)), tracks, limits)
    from_recent = P.classify_recent(recent, tracks, limits).where(day.isin(days))
    kept = P.dedup_recent(from_recent, history.select(URI, "played_at"), limits.overlap_seconds)
    return from_history.unionByName(kept).withColumn("day", day)


def rebuild_changed_days(
    spark: SparkSession,
    tables: Tables,
    ledger: Ledger,
    run: str,
    as_of: Column | None = None,
    limits: schemas.Thresholds = schemas.Thresholds(),
) -> list[date]:
    """Bring ``plays_by_day``, ``track_days`` and ``track_stats`` up to date; returns the days written.

    The ledger tells which landed runs are new. A run that broke off may be repeated: a change
    that was staged as a whole is completed first, and the tracks to fold again are kept until
    their statistics are written. ``days_since_last`` is as of ``as_of`` for every track.
    """
    change = SlotChange(spark, tables.base, run)
    if change.complete():
        change.install()
    used, changed = ledger.pending(LANDING, REBUILD)
    if not used:
        return []
    change.begin()
    recent_days = _folders(spark, tables.path("recent_by_day"))
    days = days_to_rebuild(changed, recent_days)
    plays = change.put("plays_by_day", _plays_of(spark, tables, days, recent_days, limits), "day")
    sums = change.put("track_days", track_days(plays), "day")
    sums_path, touched_path = tables.path("track_days"), tables.path(f"_touched-{run}")
    before = read_slots(spark, sums_path, TRACK_DAYS, "day", days).select(URI)
    touched = before.unionByName(sums.select(URI)).distinct()
    touched.write.mode("append").parquet(touched_path)  # an earlier attempt's tracks stay
    change.seal()
    change.install()

    touched = spark.read.schema(f"{URI} string").parquet(touched_path).distinct()
    tracks = read_required(spark, tables.path("track_data"), schemas.TRACK_DATA)
    folded = stats_of_days(read_slots(spark, sums_path, TRACK_DAYS, "day").join(touched, URI, "left_semi"), tracks, as_of)
    as_of = F.current_date() if as_of is None else as_of
    path = tables.path("track_stats")
    others = read_or_empty(spark, path, schemas.TRACK_STATS).join(touched, URI, "left_anti")
    others = others.withColumn("days_since_last", F.datediff(as_of, F.to_date("last_played_at")))
    overwrite(others.unionByName(folded).hint("rebalance"), path, **TRACK_STATS_RULES)
    remove(spark, touched_path)
    ledger.record(REBUILD, run, {"days": len(days)}, days, used)
    return days


def plays_by_day(spark: SparkSession, tables: Tables, days: Iterable[date] | None = None) -> DataFrame:
    """The rebuilt plays, of some days by a filter on their folders."""
    return read_slots(spark, tables.path("plays_by_day"), PLAY_DAYS, "day", days)
