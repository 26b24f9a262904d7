"""The whole chain as one named run, every step of which the ledger counts once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession

from earshot import schemas
from earshot.operators.enrich import uris_to_enrich
from earshot.plans import ingest, pipeline
from earshot.plans.ledger import Ledger
from earshot.sources.tables import read_or_empty


@dataclass(frozen=True)
class Landed:
    """Folders of landed files."""

    history: str
    recent: str
    tracks: str
    playlists: str
    playlist_items: str


def run_all(
    spark: SparkSession,
    tables: pipeline.Tables,
    landed: Landed,
    ledger: Ledger,
    run: str,
    as_of: Column | None = None,
) -> dict[str, dict[str, int]]:
    """Landed files to tables to statistics; returns the counts of every step.

    A step that the ledger has under this run's name is not done again, so a run that broke off
    goes on where it stopped. A step that broke off itself is repeated, and what it stored
    before then counts as known, not as added.
    """
    path = tables.path

    def history() -> dict[str, int]:
        found = ingest.ingest_history(spark, landed.history, path("raw_extended_history"))
        return {"read": found.read if found else 0, "written": found.written if found else 0}

    def recent() -> dict[str, int]:
        return ingest.ingest_recent(spark, landed.recent, path("raw_recently_played"), path("recently_played_calls"))

    def to_fetch() -> dict[str, int]:
        raw = [
            read_or_empty(spark, path(name), schema)
            for name, schema in (("raw_extended_history", schemas.HISTORY), ("raw_recently_played", schemas.RECENT))
        ]
        known = read_or_empty(spark, path("track_data"), schemas.TRACK_DATA)
        rejects = read_or_empty(spark, path("track_rejects"), schemas.TRACK_PAYLOAD)
        return {"uris": uris_to_enrich(*raw, known, rejects=rejects).count()}

    def tracks() -> dict[str, int]:
        return ingest.ingest_tracks(spark, landed.tracks, path("track_data"), path("track_rejects"))

    def plays() -> dict[str, int]:
        found = pipeline.rebuild_plays(spark, tables).groupBy("source").sum("n").collect()
        return {source: n for source, n in found}

    def stats() -> dict[str, int]:
        return {"tracks": pipeline.rebuild_track_stats(spark, tables, as_of).count()}

    def tags() -> dict[str, int]:
        sync = pipeline.rebuild_tag_mapping(spark, tables, landed.playlists, landed.playlist_items)
        mapping = read_or_empty(spark, path("tag_mapping"), schemas.TAG_MAPPING)
        return {
            "mapped": mapping.count(),
            "playlists": sync.playlist_counts.count(),
            "unmatched_playlists": sync.unmatched_playlists.count(),
            "unmatched_tags": sync.unmatched_tags.count(),
        }

    steps = {
        "ingest_history": history,
        "ingest_recent": recent,
        "uris_to_enrich": to_fetch,
        "ingest_tracks": tracks,
        "uris_left": to_fetch,
        "rebuild_plays": plays,
        "rebuild_track_stats": stats,
        "rebuild_tag_mapping": tags,
    }
    return {step: ledger.once(step, run, job) for step, job in steps.items()}
