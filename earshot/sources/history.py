"""Scan of the exported history: a folder of JSON files of two shapes."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earshot.operators.clean import normalize_columns, normalize_name
from earshot.schemas import HISTORY

LISTING_THREADS = 32
SKIPPED_BYTES = frozenset(b" \t\r\n\xef\xbb\xbf")


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """(file system, path) of the Hadoop file API."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_path(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote for its own use, if it is there."""
    fs, where = hadoop_path(spark, path)
    fs.delete(where, True)


def json_files(spark: SparkSession, folder: str) -> list[str]:
    """The ``*.json`` files directly in ``folder``, sorted; an error if it is no folder."""
    fs, where = hadoop_path(spark, folder)
    if not fs.exists(where) or not fs.getFileStatus(where).isDirectory():
        raise NotADirectoryError(f"{folder!r} is not a directory")
    return sorted(
        status.getPath().toString()
        for status in fs.listStatus(where)
        if status.isFile() and status.getPath().getName().endswith(".json")
    )


def starts_with_array(spark: SparkSession, path: str) -> bool:
    """Whether the first byte that is neither blank nor part of a byte-order mark is ``[``.

    Reads single bytes and stops at the first that counts, as a rule the very first.
    """
    fs, where = hadoop_path(spark, path)
    stream = fs.open(where)
    try:
        byte = stream.read()
        while byte in SKIPPED_BYTES:
            byte = stream.read()
        return byte == ord("[")
    finally:
        stream.close()


RECORD = "map<string,string>"
#: Characters that may stand before the first of a file.
LEADING = "\ufeff \t\r\n"


def scan_records(spark: SparkSession, folder: str) -> DataFrame | None:
    """All history records of a folder as maps from their own keys to text; None without files.

    Nothing is declared and nothing inferred: one parse keeps every key of every record, nested
    values as JSON text. A file of one JSON array is one row before it is parsed, so it should fit
    a task. A record that is no object fails the job.
    """
    files = json_files(spark, folder)
    if not files:
        return None
    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        is_array = list(pool.map(lambda f: starts_with_array(spark, f), files))
    arrays = [f for f, array in zip(files, is_array, strict=True) if array]
    lines = [f for f, array in zip(files, is_array, strict=True) if not array]
    parts = []
    if arrays:
        text = F.ltrim(F.col("value"), F.lit(LEADING))
        listed = spark.read.text(arrays, wholetext=True).select(_parsed(text, f"array<{RECORD}>"))
        parts.append(listed.select(F.explode("record").alias("record")))
    if lines:
        text = F.btrim(F.col("value"), F.lit(LEADING))
        parts.append(spark.read.text(lines).where(text != "").select(_parsed(text, RECORD)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _parsed(text: Column, shape: str) -> Column:
    return F.from_json(text, shape, {"mode": "FAILFAST"}).alias("record")


def record_keys(records: DataFrame) -> dict[str, int]:
    """The keys of stored records and how many non-NULL values each has."""
    entries = records.select(F.explode("record").alias("key", "value"))
    return {r.key: r.n for r in entries.groupBy("key").agg(F.count("value").alias("n")).collect()}


def record_columns(records: DataFrame, keys: Sequence[str], normalize: bool = True) -> DataFrame:
    """Records as columns, one per key; keys that normalise to one name share it, the first value wins.

    Columns that HISTORY declares have its types, where a value of another type fails; others are
    text.
    """
    declared = {f.name: f.dataType for f in StructType.fromDDL(HISTORY)}
    groups: dict[str, list[str]] = {}
    for key in sorted(keys):
        groups.setdefault(normalize_name(key) if normalize else key, []).append(key)
    order = [*(n for n in declared if n in groups), *sorted(n for n in groups if n not in declared)]
    return records.select(
        *[
            F.coalesce(*[F.col("record")[k] for k in groups[n]]).cast(declared.get(n, "string")).alias(n)
            for n in order
        ]
    )


def scan_history(
    spark: SparkSession, folder: str, schema: str | None = HISTORY
) -> DataFrame | None:
    """All history files of a folder as one frame, or None if there are no files.

    A file is either one JSON array (possibly spread over lines) or one object per line.
    No single reader option is right for both, so the files are told apart first and read
    with two scans. Only the file list passes the driver. A file that fits neither shape
    fails the job.

    ``schema=None`` infers the columns from the files, at the price of one more pass, and
    keeps columns that ``HISTORY`` does not list.
    """
    files = json_files(spark, folder)
    if not files:
        return None
    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        is_array = list(pool.map(lambda f: starts_with_array(spark, f), files))

    parts = []
    for multi_line in (True, False):
        chosen = [f for f, array in zip(files, is_array, strict=True) if array is multi_line]
        if chosen:
            reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
            parts.append(
                reader.schema(schema).json(chosen) if schema else normalize_columns(reader.json(chosen))
            )
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first
