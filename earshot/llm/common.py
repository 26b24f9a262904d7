"""Helpers shared by the operators: written intermediate tables, folds, text slabs, fixed-size sieves."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import scratch_path
from earshot.sources.history import remove

SPACE = re.compile(rb"[\x20\x09-\x0D]")


def settle(df: DataFrame, name: str, written: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts lineage so that nothing above is computed twice and a lost executor costs only the
    running stage; the reread table has a known size, so Spark itself decides on broadcasts.
    ``written`` gets the folder, for ``forget``.
    """
    path = scratch_path(df.sparkSession, name)
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, written: list[str]) -> None:
    """Remove written tables that nothing reads any more."""
    while written:
        remove(spark, written.pop())


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts`` (a null id: of the empty text)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slabs(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Cut a text at white space into parts of about ``size`` bytes, so that word lists stay small."""
    start = 0
    while start < len(text):
        end = min(start + size, len(text))
        if end < len(text):
            gap = SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


def portions(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """First row and end of each run of rows with up to ``size`` bytes of text, or one longer text."""
    stops = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(stops):
        done = stops[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(stops, done + size, "right")))
        yield start, end
        start = end


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving freed Arrow memory back at its end: workers wait for later tasks and stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied


def sift(df: DataFrame, keys: DataFrame, column: str, buckets: int = 1 << 17) -> DataFrame:
    """Rows of ``df`` whose ``column`` may occur in ``keys``; false positives stay.

    A one-hash Bloom filter in relational form: at most ``buckets`` integers are broadcast,
    however many keys there are. The exact join that follows then shuffles far fewer rows.
    """
    cell = lambda name: F.pmod(F.xxhash64(F.col(name)), F.lit(buckets)).cast("int")
    taken = keys.select(cell(column).alias("_cell")).distinct()
    return (
        df.withColumn("_cell", cell(column))
        .join(F.broadcast(taken), "_cell", "left_semi")
        .drop("_cell")
    )


def sieve(df: DataFrame, keys: DataFrame, column: str, blocks: int = 1 << 18) -> DataFrame:
    """As ``sift`` with 64 cells in each of ``blocks`` integers: as much is broadcast, far fewer rows stay."""
    return _marked(df, keys, column, blocks, "inner").where("_held").drop("_held")


def parted(df: DataFrame, keys: DataFrame, column: str, blocks: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """Rows that ``sieve`` keeps, and the others."""
    marked = _marked(df, keys, column, blocks, "left")
    return marked.where("_held").drop("_held"), marked.where("NOT coalesce(_held, false)").drop("_held")


def _marked(df: DataFrame, keys: DataFrame, column: str, blocks: int, how: str) -> DataFrame:
    cell = F.pmod(F.xxhash64(F.col(column)), F.lit(64 * blocks))
    placed = keys.select(cell.alias("_cell")).selectExpr("_cell div 64 AS _block", "shiftleft(1L, int(_cell % 64)) AS _bit")
    taken = placed.groupBy("_block").agg(F.bit_or("_bit").alias("_bits"))
    marked = df.withColumn("_cell", cell).withColumn("_block", F.expr("_cell div 64"))
    held = F.expr("shiftrightunsigned(_bits, int(_cell % 64)) & 1 = 1").alias("_held")
    return marked.join(F.broadcast(taken), "_block", how).select(*df.columns, held)
