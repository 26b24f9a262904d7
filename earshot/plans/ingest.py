"""Loading the raw tables from landed files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot import schemas
from earshot.operators.clean import drop_duplicate_rows, trim_strings
from earshot.operators.enrich import track_rows, unique_tracks
from earshot.plans.ledger import Counter
from earshot.session import scratch_path
from earshot.sources import payloads
from earshot.sources.history import RECORD, exists, record_columns, record_keys, remove, scan_records
from earshot.sources.tables import read_or_empty, read_table, write_table


@dataclass(frozen=True)
class IngestCounts:
    """Rows read from the files, rows written, and the columns written."""

    read: int
    written: int
    columns: list[str]


def ingest_history(
    spark: SparkSession,
    folder: str,
    table: str,
    if_exists: str = "append",
    clean: bool = True,
    dedupe_existing: bool = False,
) -> IngestCounts | None:
    """Load a folder of history files into ``raw_extended_history``; None without files.

    Every key of every record becomes a column, also keys that no schema declares; with ``clean``
    names are normalised, empty columns and copies of rows go, and texts are trimmed. The JSON is
    parsed once: records are staged as Parquet in the shared scratch folder, whose keys are then
    counted on the columnar copy. The copy is removed also when the load fails.

    Loading a folder twice stores its rows twice, as copies are dropped within one run
    only. ``dedupe_existing`` also leaves out rows the table already holds.
    """
    records = scan_records(spark, folder)
    if records is None:
        return None
    staged = scratch_path(spark, "history")
    try:
        read_rows, written = Observation(), Observation()
        records.observe(read_rows, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
        read = read_rows.get["rows"]
        stored = spark.read.schema(f"record {RECORD}").parquet(staged)
        keys = record_keys(stored)
        if not read or not keys:
            return IngestCounts(read, 0, [])
        rows = record_columns(stored, [k for k, n in keys.items() if n or not clean], clean)
        if clean:
            rows = drop_duplicate_rows(trim_strings(rows))
        if dedupe_existing and exists(spark, table):
            rows = _not_in(rows, read_table(spark, table))
        write_table(rows.observe(written, F.count(F.lit(1)).alias("rows")), table, if_exists)
        return IngestCounts(read, written.get["rows"], rows.columns)
    finally:
        remove(spark, staged)


def _not_in(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows without an equal row in ``table``; a column one side lacks counts as NULL."""
    types = {f.name: f.dataType for f in [*table.schema.fields, *rows.schema.fields]}

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind).alias(name)
                for name, kind in types.items()
            ]
        )

    missing = aligned(rows).subtract(aligned(table))
    return missing.select(*[f"`{c}`" for c in rows.columns])


def new_recent_rows(spark: SparkSession, rows: DataFrame, table: str) -> DataFrame:
    """Distinct rows that the stored table of recent plays does not hold yet.

    Storing just these leaves the same table as appending all and rewriting it without
    copies, but costs the size of the batch, not of the table: the batch's time range (one
    row of two values on the driver) limits what is read of the table.
    """
    fresh = rows.dropDuplicates()
    if not exists(spark, table):
        return fresh
    first, last = rows.agg(
        F.min("played_at").cast("string"), F.max("played_at").cast("string")
    ).first()
    stored = read_or_empty(spark, table, schemas.RECENT).where(
        F.col("played_at").between(
            F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")
        )
    )
    return fresh.join(stored, ["track_name", "played_at", "spotify_track_uri"], "left_anti")


def ingest_recent(
    spark: SparkSession,
    folder: str,
    recent_table: str,
    calls_table: str,
    tz: str = schemas.HOME_TIMEZONE,
    call_made: datetime | None = None,
) -> dict[str, int]:
    """Load landed recently-played pages: one audit row per page, distinct plays.

    Pages are told apart by file and content, and ``calls_table`` records them; a page it holds
    is neither audited nor loaded again, and files that it holds as they are aren't read. ``call_made`` is when the page's file was written,
    unless given. Returns the pages that were new, their plays, and the plays that were added.
    """
    source: str | list[str] = folder
    calls = read_or_empty(spark, calls_table, schemas.RECENT_CALLS).where("page IS NOT NULL") if exists(spark, calls_table) else None
    if calls is not None:
        source = payloads.unread_files(spark, folder, calls)
        if not source:
            return {"pages": 0, "plays": 0, "added": 0}
    pages = payloads.read_pages(spark, source, schemas.RECENT_PAGE, located=True)
    if calls is not None:
        pages = pages.join(calls.select("page"), "page", "left_anti")
    staged, counter = scratch_path(spark, "pages"), Counter()
    try:
        counter.watch("pages", pages).write.parquet(staged)
        fresh = spark.read.schema(pages.schema).parquet(staged)
        rows = counter.watch("plays", payloads.recent_rows(fresh, tz))
        write_table(counter.watch("added", new_recent_rows(spark, rows, recent_table)), recent_table)
        # Last, so that a load that broke off is done again; its plays are then known already.
        write_table(payloads.call_rows(fresh, call_made, tz), calls_table)
        return counter.counts()
    finally:
        remove(spark, staged)


def ingest_tracks(spark: SparkSession, folder: str, table: str, rejects: str) -> dict[str, int]:
    """Add landed track payloads to ``track_data``; tracks it already holds stay as they are.

    Artists stay one array column, so a track with more artists changes no schema. Rejected
    payloads are stored once each, however often the folder is loaded. Returns the usable payloads, the
    tracks that were added, and the payloads that were newly rejected.
    """
    counter = Counter()
    rows, bad = track_rows(payloads.scan_tracks(spark, folder))
    rows = counter.watch("usable", rows)
    known = read_or_empty(spark, table, schemas.TRACK_DATA).select("source_uri")
    write_table(counter.watch("added", unique_tracks(rows).join(known, "source_uri", "left_anti")), table)
    fresh = bad.dropDuplicates()
    if exists(spark, rejects):
        fresh = fresh.subtract(read_or_empty(spark, rejects, schemas.TRACK_PAYLOAD))
    write_table(counter.watch("rejected", fresh), rejects)
    return counter.counts()
