"""Look-ups, roll-ups and stored playlists."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.plans import pipeline
from earshot.plans.rollups import monthly_sketches, rolled_up
from earshot.schemas import PLAY_COLUMNS
from earshot.sources import layout
from earshot.sources.tables import overwrite
from earshot.workload import queries as Q

SF = "/root/testdata/sf0.001"
HOUR = ("2024-02-10 08:00:00", "2024-02-10 09:00:00")


def groups(path):
    """Per row group, the range of the track's cell and of the time."""
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(names.index(c)).statistics for c in ("uri_cell", "played_at")]
            yield [(s.min, s.max) for s in stats]


def test_look_ups_touch_few_row_groups(spark, folder):
    path, plays = f"{folder}/lookup", Q._plays(spark, SF)
    layout.write_for_lookup(plays, path, n_files=256)
    spans = list(groups(path))
    assert len(spans) > 200
    uri = plays.groupBy("spotify_track_uri").count().orderBy(F.desc("count"), "spotify_track_uri").first()[0]
    cell = spark.range(1).select(layout._uri_cell(F.lit(uri))).first()[0]
    by_track = sum(low <= cell <= high for (low, high), _ in spans)
    by_time = sum(str(low) <= HOUR[1] and str(high) >= HOUR[0] for _, (low, high) in spans)
    assert 0 < by_track < len(spans) / 10 and 0 < by_time < len(spans) / 10
    found = layout.look_up(spark, path, uri=uri)
    assert rows(found.select(*PLAY_COLUMNS)) == rows(plays.where(F.col("spotify_track_uri") == uri))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = found._jdf.queryExecution().explainString(mode)
    (pushed,) = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert "EqualTo(spotify_track_uri" in pushed and "EqualTo(uri_cell" in pushed
    hour = plays.where(F.date_format("played_at", "yyyy-MM-dd HH:mm:ss").between(*HOUR))
    assert rows(layout.look_up(spark, path, since=HOUR[0], until=HOUR[1]).select(*PLAY_COLUMNS)) == rows(hour)


def test_plays_are_computed_once(spark, folder):
    plays, seen = Q._plays(spark, SF), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    layout.write_for_lookup(plays.mapInArrow(count, plays.schema), f"{folder}/lookup")
    assert seen.value == spark.read.parquet(f"{folder}/lookup").count()


def test_the_curve_takes_bits_by_turns(spark):
    pair = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 0), (5, 6), (65535, 65535)], "x long, y long")
    found = [r[0] for r in pair.select(layout.interleaved(F.col("x"), F.col("y"))).collect()]
    assert found == [0, 1, 2, 5, 0b111001, 2**32 - 1]


def test_a_year_from_monthly_sketches(spark):
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    at = F.timestamp_add("SECOND", (F.xxhash64("id") % 31_000_000).cast("int").bitwiseAND(F.lit(2**25 - 1)), start)
    uri = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string")))
    plays = spark.range(20_000).select(at.alias("played_at"), uri.alias("spotify_track_uri"))
    exact = plays.groupBy("spotify_track_uri").agg(F.count("*").alias("plays"), F.count_distinct(F.to_date("played_at")).alias("days"))
    both = rolled_up(monthly_sketches(plays)).join(exact, "spotify_track_uri").collect()
    assert len(both) == 51
    for r in both:
        assert r[1] == r[3] and abs(r.days_played - r.days) <= 0.05 * r.days
    (year,) = rolled_up(monthly_sketches(plays), [F.lit("all").alias("all")]).collect()
    assert year.plays == 20_000 and abs(year.days_played - 366) < 25


def test_playlists_are_stored_by_name(spark, folder):
    tables = pipeline.Tables(f"{folder}/tables")
    tracks = lambda *uris: spark.createDataFrame([(u,) for u in uris], "spotify_track_uri string")
    assert pipeline.store_playlist(spark, tables, tracks("a", "b", "a"), "one") == 1
    assert pipeline.store_playlist(spark, tables, tracks("c"), "two", uri="spotify:playlist:2", tag_id=4) == 2
    assert pipeline.store_playlist(spark, tables, tracks("d"), "one") == 1
    assert rows(pipeline.stored_playlists(spark, tables)) == [(1, "one", "d"), (2, "two", "c")]


def test_a_rule_that_breaks_leaves_nothing_staged(spark, folder):
    path = f"{folder}/table"
    overwrite(spark.range(3), path, not_null=["id"])
    bad = spark.createDataFrame([(None,)], "id long")
    with pytest.raises(ValueError, match="not null"):
        overwrite(bad, path, not_null=["id"])
    assert [p.name for p in Path(folder).iterdir()] == ["table"]
