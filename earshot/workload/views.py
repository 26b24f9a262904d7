"""The raw tables of a play log, derived from the benchmark tables.

Every event becomes one history row and one recent play, every part a track with its
payload and its playlist entries, so the work grows with the tables. Events are spread over
three months (which cross a change of the clock), recent plays trail their history row by
0, 40, 80 or 120 seconds, and some URIs are missing, empty, unknown or no track.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.schemas import AXES


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; the declared schema spares a job that reads file footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _derive(df: DataFrame, *columns: str) -> DataFrame:
    """Select SQL expressions as a plain projection, through which pruning and filters pass."""
    return df.selectExpr(*columns)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = "int(rtrim('}', substr(props, 7)))"  # props is {"k": <number>} throughout
    moved = "date_trunc('second', ts) + make_dt_interval(int(user_id % 3 * 30))"
    return _derive(
        table(spark, sf_dir, "events"),
        *("event_id", "user_id", "event_type", "value"),
        f"{number} AS k",
        f"string({number} * 7 + user_id * 13) AS n",
        f"{moved} AS second",
    )


URI = """
    CASE WHEN k = 99 AND event_id % 2 = 0 THEN ''
         WHEN k = 98 THEN concat('https://open.spotify.com/track/', n, '?si=1')
         WHEN k = 97 THEN concat('spotify:episode:', n)
         WHEN k = 96 THEN concat('spotify:track:u', n)
         WHEN k < 96 THEN concat('spotify:track:', n) END AS spotify_track_uri"""
MS_PLAYED = """
    CASE WHEN value < 5 THEN 0
         WHEN event_id % 50 != 7 THEN bigint(round(value * 1000)) END AS ms_played"""
REASON_START = """
    CASE WHEN event_id % 3 != 0 THEN 'clickrow'
         WHEN event_id % 2 = 0 THEN 'unknown' END AS reason_start"""
REASON_END = """
    CASE WHEN event_type = 'click' THEN 'fwdbtn'
         WHEN event_type = 'purchase' THEN 'trackdone'
         WHEN event_type = 'error' THEN 'backbtn'
         WHEN event_type = 'signup' THEN array(
              'endplay', 'logout', 'unexpected-exit', 'unexpected-exit-while-paused',
              'remote', 'trackerror')[int(event_id % 6)]
         WHEN event_id % 2 = 0 THEN 'unknown' END AS reason_end"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(
        _events(spark, sf_dir),
        "event_id",
        "concat(date_format(second, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z') AS ts",
        MS_PLAYED,
        URI,
        REASON_START,
        REASON_END,
        "user_id % 2 = 0 AS shuffle",
        "event_id % 5 = 0 AS offline",
        "CASE k % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'web' END AS platform",
    )


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(
        _events(spark, sf_dir),
        "event_id",
        "user_id",
        "CASE WHEN k = 95 THEN '' ELSE concat('Track ', n) END AS track_name",
        "timestampadd(SECOND, event_id % 4 * 40, second) AS instant",
        URI,
    )


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table of recent plays, but with the copies polling would drop."""
    return _derive(
        _recent(spark, sf_dir),
        "user_id",
        "track_name",
        "to_timestamp_ntz(from_utc_timestamp(instant, 'America/New_York')) AS played_at",
        "spotify_track_uri",
    )


def recent_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of up to 50 plays, ten of them seen by the poll before."""
    number = F.col("event_id")
    page = F.call_function("div", number, F.lit(40))
    both = F.when(number % 40 < 10, F.array(page, page - 1)).otherwise(F.array(page))
    item = F.struct(
        F.date_format("instant", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("played_at"),
        F.struct(
            F.nullif("track_name", F.lit("")).alias("name"), F.col("spotify_track_uri").alias("uri")
        ).alias("track"),
    )
    return (
        _recent(spark, sf_dir)
        .select(F.explode(both).alias("page"), item.alias("item"))
        .groupBy("page")
        .agg(F.collect_list("item").alias("items"))
        .select(
            F.struct(
                F.col("page").cast("string").alias("before"),
                F.when(F.col("page") % 2 == 0, (F.col("page") + 1).cast("string")).alias("after"),
            ).alias("cursors"),
            "items",
        )
    )


def track_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    artist = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(13)), F.lit(1), (key % 13).cast("int")),
        lambda i: F.struct(
            F.concat_ws("-", "p_brand", i.cast("string")).alias("name"),
            F.concat_ws(":", F.lit("artist"), i.cast("string")).alias("uri"),
        ),
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("spotify:track:"), key.cast("string")).alias("uri"),
        F.col("p_name").alias("name"),
        F.when(key % 25 == 1, 0)
        .when(key % 10 != 0, F.col("p_size") * 4000 + 20000)
        .cast("bigint")
        .alias("duration_ms"),
        (key % 3 != 0).alias("is_playable"),
        F.col("p_size").alias("popularity"),
        F.when(
            key % 4 != 0,
            F.struct(
                F.col("p_type").alias("name"),
                F.lit("2020").alias("release_date"),
                F.lit("year").alias("release_date_precision"),
                F.concat(F.lit("album:"), "p_type").alias("uri"),
            ),
        ).alias("album"),
        artist.alias("artists"),
    )


def track_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table; a track may lack a duration here, its payload would be rejected."""
    return track_payloads(spark, sf_dir).select(
        F.col("uri").alias("source_uri"),
        F.col("name").alias("track_name"),
        "duration_ms",
        "is_playable",
        "popularity",
        F.col("album.name").alias("album_name"),
        "artists",
    )


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(axis_id, word) of every word that describes a part."""
    part = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    described = F.inline(
        F.array(
            F.struct(F.lit(1).alias("axis_id"), words[0].alias("word")),
            F.struct(F.lit(3).alias("axis_id"), words[1].alias("word")),
            F.struct(F.lit(5).alias("axis_id"), F.lower("p_type").alias("word")),
        )
    )
    return part.select(described).distinct()


def axes(spark: SparkSession) -> DataFrame:
    rows = [(i, name, None) for i, name in enumerate(AXES, 1)]
    return spark.createDataFrame(rows, "axis_id int, axis string, description string")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag per word but ``economy``, and an ``unused`` one per axis in use.

    The window that numbers them runs over the words, not over the parts.
    """
    words = _words(spark, sf_dir).where(F.col("word") != "economy")
    unused = words.select(
        "axis_id", F.concat(F.lit("unused"), F.col("axis_id").cast("string")).alias("word")
    )
    names = words.unionByName(unused).groupBy("word").agg(F.min("axis_id").alias("axis_id"))
    return names.select(
        F.row_number().over(Window.orderBy("word")).alias("tag_id"),
        F.col("word").alias("tag"),
        F.lit(None).cast("string").alias("description"),
        "axis_id",
    )


def _playlist_id(axis_id: Column, word: Column) -> Column:
    return F.concat_ws(":", axis_id.cast("string"), word)


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.col("word")
    name = (
        F.when(word == "promo", "##promo")
        .when(word == "medium", "medium")
        .when(F.col("axis_id") == 5, F.concat(F.lit("#"), F.upper(word)))
        .otherwise(F.concat(F.lit("#"), word))
    )
    return _words(spark, sf_dir).select(
        _playlist_id(F.col("axis_id"), word).alias("playlist_id"), name.alias("name")
    )


def playlist_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    prefix = F.when(key % 11 == 0, "spotify:local:").otherwise("spotify:track:")
    song = F.struct(
        F.concat(prefix, key.cast("string")).alias("uri"),
        F.when(key % 7 == 0, "episode").otherwise("track").alias("type"),
    ).cast("struct<uri:string,type:string>")
    words = F.split("p_name", " ")
    member_of = F.array(
        _playlist_id(F.lit(1), words[0]),
        _playlist_id(F.lit(3), words[1]),
        _playlist_id(F.lit(5), F.lower("p_type")),
    )
    return table(spark, sf_dir, "part").select(
        F.explode(member_of).alias("playlist_id"),
        F.when(key % 2 == 0, song).alias("item"),
        F.when(key % 2 == 1, song).alias("track"),
    )
