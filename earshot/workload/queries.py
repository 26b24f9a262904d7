"""The registered queries: every operator over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot import schemas
from earshot.functions.text import present
from earshot.functions.times import local_time, month_of
from earshot.operators import clean as C
from earshot.operators import enrich as E
from earshot.operators import tags as G
from earshot.operators.timeline import gap_to_next, sessions
from earshot.plans import incremental as IN
from earshot.plans import ingest, pipeline, runs
from earshot.plans import plays as P
from earshot.plans import reports as R
from earshot.plans import stats as S
from earshot.plans.ledger import Ledger
from earshot.plans.rollups import monthly_sketches, rolled_up
from earshot.plans.toplists import daily_states, exact_top, month_of_day
from earshot.session import configure, scratch_path
from earshot.sources import payloads
from earshot.sources.history import hadoop_path, scan_history
from earshot.sources.layout import look_up, write_for_lookup
from earshot.sources.tables import (
    PLAYS_RULES,
    TRACK_STATS_RULES,
    constraint_violations,
    read_table,
    write_plays,
)
from earshot.streaming import classify as SC
from earshot.streaming import lossless as SL
from earshot.streaming import recent as SR
from earshot.streaming import repair as SP
from earshot.workload import views as V

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
AS_OF = "2024-06-01"


def plain(df: DataFrame) -> DataFrame:
    """Types any engine prints alike: decimals as double, times as text, counts as bigint."""

    def column(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.IntegerType):
            col = col.cast("bigint")
        return col.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return plain(fn(spark, sf_dir))

    REGISTRY[fn.__name__] = run
    return run


def _plays(spark: SparkSession, sf: str) -> DataFrame:
    return P.build_plays(V.history(spark, sf), V.recent(spark, sf), V.track_data(spark, sf))


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("date")
    return S.track_stats(_plays(spark, sf), V.track_data(spark, sf), as_of)


# --- history and recent plays ----------------------------------------------------------


@query
def classify_history(spark, sf):
    return P.classify_history(V.history(spark, sf), V.track_data(spark, sf))


@query
def low_confidence_dropped(spark, sf):
    """The rows the credibility filter removes, those with a NULL verdict included."""
    history = V.history(spark, sf)
    ghost = P.Q.low_confidence(F.col("ms_played"), F.col("reason_start"), F.col("reason_end"))
    dropped = history.where(present(F.col("spotify_track_uri")) & F.coalesce(ghost, F.lit(True)))
    return dropped.select(
        "event_id", "ts", "ms_played", "spotify_track_uri", "reason_start", "reason_end"
    )


def _distinct_recent(spark, sf):
    return V.recent(spark, sf).drop("user_id").dropDuplicates()


@query
def gap_to_next_play(spark, sf):
    log = V.recent(spark, sf).drop("user_id")
    return gap_to_next(log, "played_at", ["spotify_track_uri", "track_name"], distinct=True)


@query
def gap_to_next_per_user(spark, sf):
    tiebreak = ["spotify_track_uri", "track_name"]
    return gap_to_next(V.recent(spark, sf), "played_at", tiebreak, ["user_id"], distinct=True)


@query
def classify_recent(spark, sf):
    return P.classify_recent(V.recent(spark, sf), V.track_data(spark, sf))


@query
def classify_recent_per_user(spark, sf):
    return P.classify_recent(
        V.recent(spark, sf), V.track_data(spark, sf), partition_cols=["user_id"]
    )


@query
def dedup_recent(spark, sf):
    recent = P.classify_recent(V.recent(spark, sf), V.track_data(spark, sf))
    return P.dedup_recent(recent, P.history_events(V.history(spark, sf)))


@query
def plays(spark, sf):
    return _plays(spark, sf)


@query
def plays_summary(spark, sf):
    return P.plays_summary(_plays(spark, sf))


@query
def play_ids(spark, sf):
    """The surrogate key of the stored table: as many distinct values as plays."""
    path = scratch_path(spark, "plays")
    write_plays(_plays(spark, sf), path)
    return spark.read.parquet(path).agg(
        F.count("*").alias("n"), F.count_distinct("play_id").alias("n_ids")
    )


@query
def plays_constraints(spark, sf):
    """The rules of the stored table, its surrogate key among them."""
    path = scratch_path(spark, "plays")
    write_plays(_plays(spark, sf), path)
    return constraint_violations(spark.read.parquet(path), **PLAYS_RULES)


@query
def recent_distinct(spark, sf):
    """Two overlapping copies of the raw log, rows kept once."""
    log = V.recent(spark, sf).select("track_name", "played_at", "spotify_track_uri")
    return log.unionByName(log).dropDuplicates()


@query
def listening_sessions(spark, sf):
    limits = schemas.Thresholds()
    return sessions(V.recent(spark, sf), "played_at", limits.session_gap_seconds)


@query
def listening_sessions_per_user(spark, sf):
    return sessions(V.recent(spark, sf), "played_at", 6 * 3600, ["user_id"])


# --- statistics and reports ------------------------------------------------------------


@query
def monthly_plays(spark, sf):
    return S.monthly_plays(_plays(spark, sf))


@query
def peak_months(spark, sf):
    return S.peak_months(_plays(spark, sf))


@query
def peak_months_rownum(spark, sf):
    return S.peak_months_ranked(_plays(spark, sf))


@query
def track_stats(spark, sf):
    return _stats(spark, sf)


@query
def track_stats_constraints(spark, sf):
    return constraint_violations(_stats(spark, sf), **TRACK_STATS_RULES)


@query
def stats_summary(spark, sf):
    return S.stats_summary(_stats(spark, sf))


@query
def top_played(spark, sf):
    return S.top_played(_stats(spark, sf))


@query
def most_skipped(spark, sf):
    return S.most_skipped(_stats(spark, sf))


@query
def by_hour_dow(spark, sf):
    return R.by_hour_and_weekday(_plays(spark, sf))


@query
def monthly_most_played(spark, sf):
    return R.monthly_most_played(_plays(spark, sf))


@query
def monthly_most_skipped(spark, sf):
    return R.monthly_most_skipped(_plays(spark, sf))


@query
def breakdown_by_reason(spark, sf):
    return R.breakdown(V.history(spark, sf), ["reason_start", "reason_end"])


@query
def breakdown_by_device(spark, sf):
    return R.breakdown(V.history(spark, sf), ["platform", "shuffle", "offline"])


@query
def daily_anomalies(spark, sf):
    return R.daily_anomalies(_plays(spark, sf))


# --- metadata --------------------------------------------------------------------------


@query
def uris_union(spark, sf):
    return E.known_uris(V.history(spark, sf), V.recent(spark, sf))


@query
def new_uris(spark, sf):
    return E.new_uris(V.history(spark, sf), V.recent(spark, sf), V.track_data(spark, sf))


@query
def uris_to_enrich(spark, sf):
    return E.uris_to_enrich(V.history(spark, sf), V.recent(spark, sf), V.track_data(spark, sf))


@query
def uris_to_enrich_capped(spark, sf):
    """Capped runs, each storing what it fetched, until nothing is left; all they fetched."""
    history, recent = V.history(spark, sf), V.recent(spark, sf)
    known = V.track_data(spark, sf).select("source_uri")
    stored = scratch_path(spark, "fetched")
    everything = E.uris_to_enrich(history, recent, known)
    cap = max(1, -(-everything.count() // 3))
    for _ in range(3):
        E.uris_to_enrich(history, recent, known, cap).write.mode("append").parquet(stored)
        fetched = spark.read.parquet(stored)
        known = V.track_data(spark, sf).select("source_uri").unionByName(
            fetched.select(F.col("uri").alias("source_uri"))
        )
    return fetched


@query
def track_id_extract(spark, sf):
    return E.split_by_track_id(E.known_uris(V.history(spark, sf), V.recent(spark, sf)))[0]


@query
def track_id_rejects(spark, sf):
    return E.split_by_track_id(E.known_uris(V.history(spark, sf), V.recent(spark, sf)))[1]


@query
def build_track_data(spark, sf):
    rows = E.track_rows(V.track_payloads(spark, sf))[0]
    return rows.drop("artists")


@query
def track_data_rejects(spark, sf):
    return E.track_rows(V.track_payloads(spark, sf))[1].select("uri", "name")


@query
def artists_widen(spark, sf):
    return E.widen_artists(V.track_data(spark, sf).select("source_uri", "artists"))


@query
def artists_needed(spark, sf):
    return V.track_data(spark, sf).agg(
        F.max(F.size("artists")).alias("widest"), E.artists_needed().alias("columns")
    )


@query
def unique_tracks(spark, sf):
    """Two copies of the table and one of an altered table, one row per track."""
    tracks = V.track_data(spark, sf).select("source_uri", "track_name", "duration_ms")
    renamed = tracks.withColumn("track_name", F.concat(F.lit("zz "), "track_name"))
    return E.unique_tracks(tracks.unionByName(tracks).unionByName(renamed))


# --- tags ------------------------------------------------------------------------------


def _sync(spark, sf) -> G.TagSync:
    return G.sync_tags(V.tags(spark, sf), V.playlists(spark, sf), V.playlist_items(spark, sf))


@query
def sync_tags(spark, sf):
    return _sync(spark, sf).mapping


@query
def tags_per_playlist(spark, sf):
    return _sync(spark, sf).playlist_counts


@query
def unmatched_playlists(spark, sf):
    return _sync(spark, sf).unmatched_playlists


@query
def unmatched_tags(spark, sf):
    return _sync(spark, sf).unmatched_tags


def _universe(spark, sf):
    return V.track_data(spark, sf).select(F.col("source_uri").alias("spotify_track_uri"))


def _select(spark, sf, **wanted):
    return G.tag_selection(
        _universe(spark, sf), _sync(spark, sf).mapping, V.tags(spark, sf), **wanted
    )


@query
def tag_query_not(spark, sf):
    return _select(spark, sf, none_of=("red", "ring"))


@query
def tag_query_and(spark, sf):
    return _select(spark, sf, all_of=("blue", "widget"))


@query
def tag_query_or(spark, sf):
    return _select(spark, sf, any_of=("blue", "standard"))


@query
def tag_query_repeated(spark, sf):
    """A tag in two places, in another case too."""
    return _select(spark, sf, all_of=("blue",), any_of=("BLUE", "standard"))


@query
def tag_query_mixed(spark, sf):
    """(small OR large) AND gear AND NOT standard, as a condition."""
    return G.tag_query(
        _universe(spark, sf),
        _sync(spark, sf).mapping,
        V.tags(spark, sf),
        ["small", "large", "gear", "standard"],
        lambda has: (has("small") | has("large")) & has("gear") & ~has("standard"),
    )


@query
def generated_playlist(spark, sf):
    tracks = _select(spark, sf, any_of=("hot", "cold"), none_of=("anvil",))
    _, mapping = G.generated_playlist(tracks, 7, "temperature")
    return mapping.withColumn("playlist_name", F.lit("temperature"))


@query
def tags_per_axis(spark, sf):
    mapping = _sync(spark, sf).mapping
    return G.tags_per_axis(mapping, V.tags(spark, sf), V.axes(spark))


@query
def axis_conflicts(spark, sf):
    mapping = _sync(spark, sf).mapping
    return G.axis_conflicts(mapping, V.tags(spark, sf), V.axes(spark))


# --- cleaning --------------------------------------------------------------------------


def _untidy(spark, sf) -> DataFrame:
    """History rows with padded texts, an empty column, odd headers, and every row twice."""
    rows = V.history(spark, sf).select(
        F.concat(F.lit(" \t"), "ts", F.lit("\n ")).alias(" TS "),
        F.col("ms_played").alias("Ms Played"),
        F.concat(F.lit("  "), "spotify_track_uri").alias("spotify_track_uri"),
        F.concat("reason_end", F.lit("\u00a0")).alias("Reason End"),
        F.lit(None).cast("string").alias("Never Set"),
    )
    return rows.unionByName(rows)


@query
def clean_rows(spark, sf):
    return C.clean(_untidy(spark, sf))


@query
def normalize_columns(spark, sf):
    return C.normalize_columns(_untidy(spark, sf))


@query
def drop_empty_columns(spark, sf):
    return C.drop_empty_columns(C.normalize_columns(_untidy(spark, sf)))


# --- files to tables -------------------------------------------------------------------


@query
def ingest_history_files(spark, sf):
    """History rows as line-delimited JSON files, loaded with cleaning."""
    folder, stored = scratch_path(spark, "files"), scratch_path(spark, "table")
    V.history(spark, sf).drop("event_id").write.json(folder)
    ingest.ingest_history(spark, folder, stored)
    return read_table(spark, stored)


@query
def ingest_history_ragged(spark, sf):
    """Files of both shapes, with padded and capitalised headers and an undeclared column."""
    folder, stored = scratch_path(spark, "files"), scratch_path(spark, "table")
    rows = V.history(spark, sf).select(
        "event_id",
        F.struct(
            F.col("ts").alias(" TS "),
            F.col("ms_played").alias("Ms Played"),
            "spotify_track_uri",
            F.col("reason_start").alias("reason_start "),
            F.col("reason_end").alias(" Reason End "),
            "platform",
            F.concat(F.lit("x"), (F.col("event_id") % 3).cast("string")).alias("Extra Col"),
        ).alias("odd"),
        F.struct("ts", "ms_played", "spotify_track_uri", "reason_start", "reason_end", "platform").alias("plain"),
    )
    lines = rows.where("event_id % 2 = 1").select(F.to_json("plain").alias("value"))
    arrays = (
        rows.where("event_id % 2 = 0")
        .groupBy((F.col("event_id") % 400).alias("part"))
        .agg(F.to_json(F.collect_list("odd")).alias("value"))
    )
    lines.write.text(f"{folder}/lines")
    arrays.write.partitionBy("part").text(f"{folder}/arrays")  # one array a file
    fs, target = hadoop_path(spark, f"{folder}/in")
    fs.mkdirs(target)
    _, written = hadoop_path(spark, folder)
    found = fs.listFiles(written, True)
    moves = []
    while found.hasNext():
        path = found.next().getPath()
        if path.getName().endswith(".txt"):
            moves.append(path)
    for number, path in enumerate(moves):
        fs.rename(path, hadoop_path(spark, f"{folder}/in/{number}.json")[1])
    ingest.ingest_history(spark, f"{folder}/in", stored)
    return read_table(spark, stored)


@query
def scan_history_files(spark, sf):
    """The same files, scanned without cleaning: copies stay."""
    folder = scratch_path(spark, "files")
    V.history(spark, sf).drop("event_id").write.json(folder)
    return scan_history(spark, folder).select(
        "ts", "ms_played", "spotify_track_uri", "reason_start", "reason_end", "platform"
    )


def _land_pages(spark, sf) -> str:
    folder = scratch_path(spark, "pages")
    V.recent_pages(spark, sf).write.json(folder)
    return folder


@query
def ingest_recent_pages(spark, sf):
    """Overlapping polls loaded twice: the table holds each play once."""
    folder = _land_pages(spark, sf)
    stored, calls = scratch_path(spark, "table"), scratch_path(spark, "calls")
    for _ in range(2):
        ingest.ingest_recent(spark, folder, stored, calls)
    return read_table(spark, stored)


@query
def recent_calls(spark, sf):
    pages = payloads.read_pages(spark, _land_pages(spark, sf), schemas.RECENT_PAGE)
    return payloads.call_rows(pages).select("before_ts", "after_ts")


@query
def stored_calls(spark, sf):
    """The audit table after the same pages were loaded twice."""
    folder = _land_pages(spark, sf)
    stored, calls = scratch_path(spark, "table"), scratch_path(spark, "calls")
    for _ in range(2):
        ingest.ingest_recent(spark, folder, stored, calls)
    return read_table(spark, calls).select("before_ts", "after_ts")


@query
def stored_rejects(spark, sf):
    """The rejected payloads after the same files were loaded twice."""
    folder = scratch_path(spark, "payloads")
    stored, rejects = scratch_path(spark, "table"), scratch_path(spark, "rejects")
    V.track_payloads(spark, sf).write.json(folder)
    for _ in range(2):
        ingest.ingest_tracks(spark, folder, stored, rejects)
    return read_table(spark, rejects).select("uri", "name")


@query
def ingest_track_payloads(spark, sf):
    folder = scratch_path(spark, "payloads")
    stored, rejects = scratch_path(spark, "table"), scratch_path(spark, "rejects")
    V.track_payloads(spark, sf).write.json(folder)
    for _ in range(2):
        ingest.ingest_tracks(spark, folder, stored, rejects)
    return read_table(spark, stored).drop("artists")


@query
def sync_tags_pages(spark, sf):
    """Playlist pages and the tag table on disk, the mapping table replaced twice."""
    tables = pipeline.Tables(scratch_path(spark, "base"))
    lists, items = scratch_path(spark, "lists"), scratch_path(spark, "items")
    V.tags(spark, sf).write.parquet(tables.path("tags"))
    entry = F.struct(F.col("playlist_id").alias("id"), "name")
    V.playlists(spark, sf).select(F.array(entry).alias("items")).write.json(lists)
    V.playlist_items(spark, sf).select(
        "playlist_id", F.array(F.struct("item", "track")).alias("items")
    ).write.json(items)
    for _ in range(2):
        pipeline.rebuild_tag_mapping(spark, tables, lists, items)
    return read_table(spark, tables.path("tag_mapping"))


@query
def pipeline_track_stats(spark, sf):
    """Raw tables on disk to ``plays`` to ``track_stats``, every table written and read."""
    tables = pipeline.Tables(scratch_path(spark, "base"))
    V.history(spark, sf).write.parquet(tables.path("raw_extended_history"))
    V.recent(spark, sf).write.parquet(tables.path("raw_recently_played"))
    V.track_data(spark, sf).write.parquet(tables.path("track_data"))
    pipeline.rebuild_plays(spark, tables)
    return pipeline.rebuild_track_stats(spark, tables, F.lit(AS_OF).cast("date"))


# --- streams ---------------------------------------------------------------------------


@query
def stream_recent(spark, sf):
    """Landed pages as a stream, overlap dropped by state."""
    folder = _land_pages(spark, sf)
    stored, marks = scratch_path(spark, "table"), scratch_path(spark, "marks")
    plays_of_pages = SR.distinct_recent(SR.page_stream(spark, folder), look_back="120 days")
    SR.stream_table(plays_of_pages, stored, marks).awaitTermination()
    return spark.read.parquet(stored)


@query
def stream_recent_exact(spark, sf):
    """The same with the check against the stored table, one file per batch."""
    folder = _land_pages(spark, sf)
    stored, calls = scratch_path(spark, "table"), scratch_path(spark, "calls")
    SR.start_recent_ingest(
        SR.page_stream(spark, folder), stored, calls, scratch_path(spark, "marks")
    ).awaitTermination()
    return spark.read.parquet(stored)


@query
def stream_classify(spark, sf):
    """Recent plays arriving month by month, classified as the next play becomes known."""
    landing, output = scratch_path(spark, "landing"), scratch_path(spark, "output")
    marks = scratch_path(spark, "marks")
    tracks = V.track_data(spark, sf)
    rows = _distinct_recent(spark, sf)
    month = F.trunc(F.to_date("played_at"), "MM")
    arrivals = ("0001-01-01", "2024-02-01", "2024-03-01", "9999-01-01")
    last = -1
    for since, until in zip(arrivals, arrivals[1:]):
        due = (month >= F.lit(since).cast("date")) & (month < F.lit(until).cast("date"))
        rows.where(due).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schemas.RECENT).parquet(landing)
        run = SC.start_classification(stream, tracks, output, marks)
        run.awaitTermination()
        last += 1
    return SC.classified_so_far(spark, output, tracks, last)


@query
def stream_overlap(spark, sf):
    """Stream of recent plays against the static history."""
    landing, stored = scratch_path(spark, "landing"), scratch_path(spark, "table")
    _distinct_recent(spark, sf).write.parquet(landing)
    stream = spark.readStream.schema(schemas.RECENT).parquet(landing)
    kept = SC.stream_without_overlap(stream, P.history_events(V.history(spark, sf)))
    SR.stream_table(kept, stored, scratch_path(spark, "marks")).awaitTermination()
    return spark.read.schema(schemas.RECENT).parquet(stored)


@query
def stream_overlap_bounded(spark, sf):
    """The same per batch, with the history cut to the times of the batch."""
    landing, stored = scratch_path(spark, "landing"), scratch_path(spark, "table")
    _distinct_recent(spark, sf).write.parquet(landing)
    stream = spark.readStream.schema(schemas.RECENT).parquet(landing)
    history = P.history_events(V.history(spark, sf))
    SC.start_overlap_check(
        stream, history, stored, scratch_path(spark, "marks")
    ).awaitTermination()
    return spark.read.schema(schemas.RECENT).parquet(stored).drop("batch_id")


@query
def stream_sessions(spark, sf):
    """Session windows per user over the stream, as a table replaced on every batch."""
    landing, stored = scratch_path(spark, "landing"), scratch_path(spark, "table")
    rows = V.recent(spark, sf).select("user_id", F.col("played_at").cast("timestamp").alias("at"))
    rows.write.parquet(landing)
    stream = spark.readStream.schema("user_id bigint, at timestamp").parquet(landing)
    windows = SR.session_windows(stream, "at", 6 * 3600, ("user_id",))

    def store(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(stored)

    (
        windows.writeStream.foreachBatch(store)
        .outputMode("complete")
        .option("checkpointLocation", scratch_path(spark, "marks"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(stored)


def _delivered(spark, df: DataFrame, landing: str, parts: list, run: Callable[[DataFrame], object]) -> None:
    """Let the parts of a frame (conditions) arrive one after the other, with a run after each."""
    for part in parts:
        df.where(part).write.mode("append").parquet(landing)
        run(spark.readStream.schema(df.schema).parquet(landing)).awaitTermination()


def _dealt(df: DataFrame, n: int) -> list:
    """Conditions that deal rows out by a hash, so that every part has plays of every time."""
    return [F.pmod(F.xxhash64(*df.columns), F.lit(n)) == i for i in range(n)]


@query
def stream_classify_shuffled(spark, sf):
    """Recent plays in three deliveries, each of plays of all times: late ones end in the result."""
    landing, output, marks = (scratch_path(spark, x) for x in ("landing", "output", "marks"))
    tracks, rows = V.track_data(spark, sf), _distinct_recent(spark, sf)
    start = lambda stream: SP.start_repairing_classification(stream, tracks, output, marks)
    _delivered(spark, rows, landing, _dealt(rows, 3), start)
    return SP.classified_log(spark, output)


@query
def stream_classify_shuffled_per_user(spark, sf):
    landing, output, marks = (scratch_path(spark, x) for x in ("landing", "output", "marks"))
    tracks, rows = V.track_data(spark, sf), V.recent(spark, sf)
    start = lambda stream: SP.start_repairing_classification(stream, tracks, output, marks, partition_cols=["user_id"])
    _delivered(spark, rows, landing, _dealt(rows, 3), start)
    return SP.classified_log(spark, output, ["user_id bigint"])


@query
def stream_recent_two_tiers(spark, sf):
    """Landed pages in three deliveries, with plays months behind the look-back; nothing is lost."""
    folder, output, marks = (scratch_path(spark, x) for x in ("pages", "output", "marks"))
    pages = V.recent_pages(spark, sf)
    for part in _dealt(pages.select("cursors"), 3):
        pages.where(part).write.mode("append").json(folder)
        SL.start_lossless_ingest(SR.page_stream(spark, folder), output, marks).awaitTermination()
    return SL.ingested(spark, output)


@query
def stream_sessions_closed(spark, sf):
    """Session windows per user in append mode: those that are over at the last watermark."""
    landing, stored, marks = (scratch_path(spark, x) for x in ("landing", "table", "marks"))
    rows = V.recent(spark, sf).select("user_id", F.col("played_at").cast("timestamp").alias("at"))
    month = F.date_format("at", "yyyy-MM")
    parts = [month <= "2024-01", month == "2024-02", month > "2024-02"]
    start = lambda stream: SR.start_sessions(stream, "at", 6 * 3600, ("user_id",), stored, marks)
    _delivered(spark, rows, landing, parts, start)
    return spark.read.parquet(stored)


@query
def stream_overlap_streams(spark, sf):
    """Recent plays and history both as streams; a mark far ahead in each closes what came before."""
    rows = _distinct_recent(spark, sf)
    events = P.history_events(V.history(spark, sf)).select("spotify_track_uri", "played_at")
    folders, stored = [scratch_path(spark, x) for x in ("recent", "history")], scratch_path(spark, "table")
    far = F.expr("TIMESTAMP_NTZ'2100-01-01 00:00:00'").alias("played_at")
    end = spark.range(1).select(F.lit("").alias("track_name"), far, F.lit("").alias("spotify_track_uri"))
    for df, folder in zip((rows, events), folders, strict=True):
        df.unionByName(end.select(*df.columns)).write.parquet(folder)
    streams = [spark.readStream.schema(d.schema).parquet(f) for d, f in zip((rows, events), folders, strict=True)]
    kept = SC.stream_without_stream_overlap(*streams)
    SR.stream_table(kept, stored, scratch_path(spark, "marks")).awaitTermination()
    return spark.read.schema(schemas.RECENT).parquet(stored)


@query
def stream_overlap_by_day(spark, sf):
    """A stream of recent plays against the days of the history that each batch reaches."""
    landing, by_day, stored, marks = (scratch_path(spark, x) for x in ("landing", "history", "table", "marks"))
    SC.write_history_by_day(P.history_events(V.history(spark, sf)), by_day)
    rows = _distinct_recent(spark, sf)
    start = lambda stream: SC.start_overlap_check_by_day(stream, by_day, stored, marks)
    _delivered(spark, rows, landing, _dealt(rows, 2), start)
    return spark.read.schema(schemas.RECENT).parquet(stored).drop("batch_id")


# --- incremental rebuild and ledger ----------------------------------------------------


def _landed(spark, sf) -> tuple[pipeline.Tables, Ledger]:
    tables = pipeline.Tables(scratch_path(spark, "base"))
    V.track_data(spark, sf).write.parquet(tables.path("track_data"))
    return tables, Ledger(spark, tables.path("ledger"))


def _rebuilt_after_one_day(spark, sf) -> pipeline.Tables:
    """All days but one landed and built, then that day landed and the days it reaches built again."""
    tables, ledger = _landed(spark, sf)
    late = "{0} = DATE'2024-02-10'"
    history, recent = V.history(spark, sf), V.recent(spark, sf)
    for run, way in (("first", "NOT {0}"), ("second", "{0}")):
        of_history, of_recent = (way.format(late.format(f"to_date({c})")) for c in ("to_timestamp_ntz(left(ts, 19))", "played_at"))
        IN.land_history(spark, tables, ledger, run, history.where(of_history))
        IN.land_recent(spark, tables, ledger, run, recent.where(of_recent))
        IN.rebuild_changed_days(spark, tables, ledger, run, F.lit(AS_OF).cast("date"))
    return tables


@query
def rebuild_after_one_day(spark, sf):
    """The statistics after an incremental rebuild."""
    tables = _rebuilt_after_one_day(spark, sf)
    return spark.read.schema(schemas.TRACK_STATS).parquet(tables.path("track_stats"))


@query
def plays_after_one_day(spark, sf):
    """The plays after an incremental rebuild."""
    return IN.plays_by_day(spark, _rebuilt_after_one_day(spark, sf)).select(*schemas.PLAY_COLUMNS)


def _land(frames: dict[str, DataFrame]) -> None:
    """Write JSON folders side by side: they don't depend on each other, and one's last tasks leave cores idle."""
    with ThreadPoolExecutor(len(frames)) as pool:
        written = [pool.submit(inheritable_thread_target(df.sparkSession)(df.write.json), path) for path, df in frames.items()]
    for job in written:
        job.result()


def _run_twice(spark, sf) -> Ledger:
    """The whole chain from landed files, twice under one name: the second time every step is known."""
    tables = pipeline.Tables(scratch_path(spark, "base"))
    landed = runs.Landed(*(scratch_path(spark, x) for x in ("history", "pages", "payloads", "lists", "items")))
    entry = F.struct(F.col("playlist_id").alias("id"), "name")
    items = F.array(F.struct("item", "track")).alias("items")
    _land(
        {
            landed.history: V.history(spark, sf).drop("event_id"),
            landed.recent: V.recent_pages(spark, sf),
            landed.tracks: V.track_payloads(spark, sf),
            landed.playlists: V.playlists(spark, sf).select(F.array(entry).alias("items")),
            landed.playlist_items: V.playlist_items(spark, sf).select("playlist_id", items),
        }
    )
    V.tags(spark, sf).write.parquet(tables.path("tags"))
    ledger = Ledger(spark, tables.path("ledger"))
    for _ in range(2):
        runs.run_all(spark, tables, landed, ledger, "night", F.lit(AS_OF).cast("date"))
    return ledger


@query
def run_ledger(spark, sf):
    """What every step of the chain counted."""
    counted = _run_twice(spark, sf).counted()
    return counted.select("step", "run", "name", "rows")


@query
def stream_calls(spark, sf):
    """The audit rows of a stream of pages, and its batches run again."""
    folder, output, marks = (scratch_path(spark, x) for x in ("pages", "output", "marks"))
    pages = V.recent_pages(spark, sf)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))

    def again(batch, batch_id, counts):
        ledger.record("stream_recent", f"batch-{batch_id}", counts)
        SL.store_batch(batch, batch_id, output)

    for part in _dealt(pages.select("cursors"), 2):
        pages.where(part).write.mode("append").json(folder)
        SL.start_lossless_ingest(SR.page_stream(spark, folder), output, marks, on_batch=again).awaitTermination()
    counts = ledger.counted().groupBy("name").agg(F.sum("rows").alias("rows")).where("name IN ('pages', 'added')")
    calls = SL.calls(spark, output).select("before_ts", "after_ts", F.lit(None).cast("string").alias("name"), F.lit(None).cast("bigint").alias("rows"))
    return calls.unionByName(counts, allowMissingColumns=True)


# --- layout, roll-ups, stored playlists, modes of ingest -------------------------------


@query
def plays_looked_up(spark, sf):
    """A track's plays and an hour's plays from the layout for look-ups."""
    path = scratch_path(spark, "lookup")
    write_for_lookup(_plays(spark, sf), path)
    of_track = look_up(spark, path, uri="spotify:track:100")
    of_hour = look_up(spark, path, since="2024-02-10 08:00:00", until="2024-02-10 08:59:59")
    return of_track.unionByName(of_hour)


@query
def quarter_from_sketches(spark, sf):
    """Play counts and days of three months folded from stored monthly sketches."""
    path = scratch_path(spark, "months")
    monthly_sketches(_plays(spark, sf)).write.parquet(path)
    months = spark.read.parquet(path).where("month BETWEEN '2024-01' AND '2024-03'")
    return rolled_up(months)


def _plays_and_states(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Plays and their daily frequency sketches, both stored."""
    base = scratch_path(spark, "toplists")
    _plays(spark, sf).select("spotify_track_uri", "played_at").write.parquet(f"{base}/plays")
    plays = spark.read.parquet(f"{base}/plays")
    daily_states(plays).write.parquet(f"{base}/states")
    return plays, spark.read.parquet(f"{base}/states")


@query
def top_from_states(spark, sf):
    """The most played tracks, candidates from stored daily sketches."""
    return exact_top(*_plays_and_states(spark, sf)).drop("group")


@query
def monthly_top_from_states(spark, sf):
    """The most played tracks of each month, candidates from stored daily sketches."""
    plays, states = _plays_and_states(spark, sf)
    return exact_top(plays, states, month_of(F.col("played_at")), month_of_day()).withColumnRenamed("group", "month")


@query
def stored_playlist_tables(spark, sf):
    """Two playlists stored, one of them twice, read back with their names."""
    tables = pipeline.Tables(scratch_path(spark, "base"))
    pipeline.store_playlist(spark, tables, _select(spark, sf, all_of=("blue",)), "temperature")
    pipeline.store_playlist(spark, tables, _select(spark, sf, all_of=("blue", "widget")), "blue widgets")
    hot = _select(spark, sf, any_of=("hot", "cold"), none_of=("anvil",))
    pipeline.store_playlist(spark, tables, hot, "temperature")
    return pipeline.stored_playlists(spark, tables)


@query
def ingest_history_replaced(spark, sf):
    """History files loaded twice without cleaning, the table replaced: copies within a load stay."""
    folder, stored = scratch_path(spark, "files"), scratch_path(spark, "table")
    V.history(spark, sf).drop("event_id").write.json(folder)
    for _ in range(2):
        ingest.ingest_history(spark, folder, stored, if_exists="replace", clean=False)
    return read_table(spark, stored)


@query
def refused_loads(spark, sf):
    """Loads that must fail, and how: no folder, a file for a folder, a table that is there."""
    folder, stored = scratch_path(spark, "files"), scratch_path(spark, "table")
    V.history(spark, sf).drop("event_id").write.json(folder)
    ingest.ingest_history(spark, folder, stored)
    part = next(iter(spark.read.text(folder).inputFiles()))
    tried = {"no folder": (f"{folder}-none", "append"), "a file": (part, "append"), "table there": (folder, "fail")}
    found = []
    for name, (source, mode) in tried.items():
        try:
            ingest.ingest_history(spark, source, stored, if_exists=mode)
            found.append((name, "loaded"))
        except (NotADirectoryError, AnalysisException) as error:
            found.append((name, type(error).__name__))
    n_rows = spark.read.parquet(stored).count()
    return spark.createDataFrame([(*f, n_rows) for f in found], "load string, outcome string, n_rows bigint")


@query
def artist_column_count(spark, sf):
    """The artist columns a wide table has, counted by name, against what its rows ask for."""
    tracks = V.track_data(spark, sf)
    wide = E.widen_artists(tracks)
    return tracks.agg(E.artists_needed(E.artist_columns(wide)).alias("needed")).withColumn(
        "columns", F.lit(E.artist_columns(wide)).cast("bigint")
    )


@query
def calls_made_now(spark, sf):
    """Audit rows of pages without a landing time: each is made at the present time of the home zone."""
    pages = V.recent_pages(spark, sf)
    now = local_time(F.current_timestamp(), schemas.HOME_TIMEZONE)
    calls = payloads.call_rows(pages)
    late = F.abs(F.unix_timestamp("call_made") - F.unix_timestamp(now)) <= 60
    return calls.agg(F.count("*").alias("n"), F.count_if(late).alias("n_now"))
