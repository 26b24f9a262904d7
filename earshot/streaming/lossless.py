"""Continuous ingest that loses no play, however late its page lands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot import schemas
from earshot.sources import payloads
from earshot.sources.history import exists, remove
from earshot.sources.tables import read_or_empty

IDENTITY = ["track_name", "played_at", "spotify_track_uri"]
#: Seconds behind the newest play within which the keys are kept as state.
LOOK_BACK = 2 * 86_400


def store_batch(
    pages: DataFrame, batch_id: int, output: str, look_back: int = LOOK_BACK, tz: str = schemas.HOME_TIMEZONE
) -> dict[str, int]:
    """Add the plays of some pages to ``<output>/plays``; returns counts.

    Two tiers tell whether a play is known. ``<output>/window`` holds the keys of the last
    ``look_back`` seconds before the newest play; most plays are looked up there, and its size
    doesn't grow with the table. Plays from before that, which a watermark would drop, are
    looked up in the stored table, in the folders of just their days. ``<output>/calls`` gets an audit
    row per page. Each batch writes its own folders, which its next attempt replaces.
    """
    spark = pages.sparkSession
    played = F.col("played_at")
    root = f"{output}/_batch-{batch_id}"
    remove(spark, root)
    payloads.call_rows(pages, None, tz).write.mode("overwrite").parquet(f"{output}/calls/batch_id={batch_id}")
    rows = payloads.recent_rows(pages, tz)
    rows.dropDuplicates(IDENTITY).withColumn("day", F.to_date(played)).write.parquet(f"{root}/fresh")
    fresh = spark.read.schema(f"{schemas.RECENT}, day date").parquet(f"{root}/fresh")
    window = read_or_empty(spark, f"{output}/window/batch_id={batch_id - 1}", schemas.RECENT)
    before = window.agg(F.max(played).cast("string")).first()[0]
    back = F.make_dt_interval(secs=F.lit(look_back))
    inside = F.lit(True) if before is None else played >= F.lit(before).cast("timestamp_ntz") - back

    # Without a window there is no table yet, or a batch without plays came before.
    late = fresh.where(~inside) if before else fresh
    days = [r.day for r in late.select("day").distinct().collect()]
    stored = _stored(spark, output).where(F.col("day").isin(days) & (F.col("batch_id") < batch_id))
    known = stored.select(*IDENTITY)
    new = late.join(known, IDENTITY, "left_anti").withColumn("late", F.lit(True))
    if before:
        recent = fresh.where(inside).join(window, IDENTITY, "left_anti").withColumn("late", F.lit(False))
        new = new.unionByName(recent)
    folder = f"{output}/plays/batch_id={batch_id}"
    new.write.mode("overwrite").partitionBy("day").parquet(folder)

    keys = window.unionByName(fresh.select(*IDENTITY))
    newest = keys.agg(F.max(played).cast("string")).first()[0]
    if newest is not None:
        keys = keys.where(played >= F.lit(newest).cast("timestamp_ntz") - back).dropDuplicates()
    keys.write.mode("overwrite").parquet(f"{output}/window/batch_id={batch_id}")
    n_pages = read_or_empty(spark, f"{output}/calls/batch_id={batch_id}", schemas.RECENT_CALLS).count()
    n_rows = fresh.count()
    added = {r.late: r["count"] for r in spark.read.schema(f"{schemas.RECENT}, late boolean").parquet(folder).groupBy("late").count().collect()}
    # A batch that is run again needs the window of the batch before it, none older.
    remove(spark, f"{output}/window/batch_id={batch_id - 2}")
    remove(spark, root)
    return {"pages": n_pages, "plays": n_rows, "added": sum(added.values()), "added_late": added.get(True, 0) if before else 0}


def _stored(spark: SparkSession, output: str) -> DataFrame:
    schema = f"{schemas.RECENT}, late boolean, batch_id bigint, day date"
    if not exists(spark, f"{output}/plays"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{output}/plays")


def ingested(spark: SparkSession, output: str) -> DataFrame:
    """The distinct plays so far."""
    return _stored(spark, output).select(*IDENTITY)


def calls(spark: SparkSession, output: str) -> DataFrame:
    """The audit rows so far, one per page."""
    return read_or_empty(spark, f"{output}/calls", f"{schemas.RECENT_CALLS}, batch_id bigint").drop("batch_id")


def start_lossless_ingest(
    pages: DataFrame,
    output: str,
    checkpoint: str,
    look_back: int = LOOK_BACK,
    tz: str = schemas.HOME_TIMEZONE,
    on_batch=None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the new plays of a stream of pages, each exactly once.

    ``on_batch(pages, batch_id, counts)`` is called after a batch is stored, say by a ledger.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        counts = store_batch(batch, batch_id, output, look_back, tz)
        if on_batch:
            on_batch(batch, batch_id, counts)

    return (
        pages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
