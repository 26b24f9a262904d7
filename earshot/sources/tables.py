"""Stored tables: reading, and writing with the guarantees the jobs need."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot.schemas import PLAY_COLUMNS
from earshot.sources.history import exists, hadoop_path

WRITE_MODES = {"fail": "errorifexists", "append": "append"}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table of any columns. Columns that later appends added are merged in, for
    which the footers of all files are read; tables of declared columns use read_or_empty."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows if it does not exist yet. Other errors stay errors."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_required(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table that must be there, put back in place if a swap broke off."""
    recover(spark, path)
    if not exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.schema(schema).parquet(path)


def recover(spark: SparkSession, path: str) -> None:
    """Where a swap ended between its two renames, return the table it had set aside."""
    fs, target = hadoop_path(spark, path)
    if fs.exists(target) or not fs.exists(target.getParent()):
        return
    aside = [
        status
        for status in fs.listStatus(target.getParent())
        if status.getPath().getName().startswith(f"{target.getName()}.retired-")
    ]
    if aside:
        latest = max(aside, key=lambda status: status.getModificationTime())
        if not fs.rename(latest.getPath(), target):
            raise OSError(f"could not return {latest.getPath()} to {path}")


def write_table(df: DataFrame, path: str, if_exists: str = "append") -> None:
    """Append to a table, replace it by a staged copy, or fail if it is there."""
    if if_exists == "replace":
        overwrite(df, path)
    else:
        df.write.mode(WRITE_MODES[if_exists]).parquet(path)


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    not_null: Sequence[str] = (),
    key: Sequence[str] = (),
    max_length: dict[str, int] | None = None,
) -> None:
    """Replace a table: write the new one beside it, check its rules, swap the folders.

    If the job or a rule fails the old table is still in place. ``df`` may read the old
    table. Column rules are observed while the rows are written and cost no further pass;
    the key rule aggregates the key columns of the written copy.
    """
    spark = df.sparkSession
    recover(spark, path)
    fs, target = hadoop_path(spark, path)
    token = uuid.uuid4().hex
    staged_path, retired_path = f"{path}.staged-{token}", f"{path}.retired-{token}"
    rules = _column_rules(not_null, max_length)
    _, staged = hadoop_path(spark, staged_path)
    try:
        if rules:
            seen = Observation()
            observed = [rule.alias(name) for name, rule in rules.items()]
            df.observe(seen, *observed).write.partitionBy(*partition_by).parquet(staged_path)
            _raise_broken(seen.get)
        else:
            df.write.partitionBy(*partition_by).parquet(staged_path)
        if key:
            check_constraints(read_or_empty(spark, staged_path, _ddl(df)), key=key)
    except BaseException:
        fs.delete(staged, True)
        raise

    _, retired = hadoop_path(spark, retired_path)
    if fs.exists(target) and not fs.rename(target, retired):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(staged, target):
        fs.rename(retired, target)
        raise OSError(f"could not move the new table to {path}")
    if fs.exists(retired):
        fs.delete(retired, True)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_plays(df: DataFrame, path: str) -> None:
    """Rebuild ``plays``: a folder per source, sorted for min/max skipping by track.

    The rebalance hint lets AQE split a source that holds most of the rows and merge a
    small one, so files come out near the advisory size.
    """
    laid_out = df.hint("rebalance", "source").sortWithinPartitions(
        "source", "spotify_track_uri", "played_at"
    )
    # Numbered by the tasks that write, so that a repeated one hands out its own numbers again.
    overwrite(with_play_id(laid_out), path, ["source"], **PLAYS_RULES)


def with_play_id(plays: DataFrame) -> DataFrame:
    """Surrogate key: unique within one build, no meaning beyond it, needs no shuffle."""
    return plays.select(F.monotonically_increasing_id().alias("play_id"), *PLAY_COLUMNS)


def write_stats(df: DataFrame, path: str) -> None:
    """Rebuild ``track_stats``."""
    overwrite(df.hint("rebalance"), path, **TRACK_STATS_RULES)


def _column_rules(not_null: Sequence[str], max_length: dict[str, int] | None) -> dict[str, Column]:
    """Rule name to the aggregate that counts its violations."""
    rules = {f"{c} not null": F.count_if(F.col(c).isNull()) for c in not_null}
    for column, width in (max_length or {}).items():
        rules[f"{column} length <= {width}"] = F.count_if(F.length(column) > width)
    return rules


def constraint_violations(
    df: DataFrame,
    not_null: Sequence[str] = (),
    key: Sequence[str] = (),
    max_length: dict[str, int] | None = None,
) -> DataFrame:
    """One row ``(rule, violations)`` per declared rule; duplicates count surplus rows.

    One pass over ``df``: with a key, rows fold by it, and the counts of the column rules ride along.
    """
    rules = _column_rules(not_null, max_length)
    names = {f"r{i}": name for i, name in enumerate(rules)}
    counts = [rule.alias(column) for column, rule in zip(names, rules.values(), strict=True)]
    found = df
    if key:
        names["surplus"] = f"unique ({', '.join(key)})"
        folded = df.groupBy(*key).agg((F.count("*") - 1).alias("surplus"), *counts)
        counts = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names]
        found = folded
    if not counts:
        raise ValueError("no rule given")
    pairs = [
        F.struct(F.lit(name).alias("rule"), F.col(column).alias("violations"))
        for column, name in names.items()
    ]
    return found.agg(*counts).select(F.inline(F.array(*pairs)))


def check_constraints(df: DataFrame, **rules) -> None:
    """Raise if any rule of ``constraint_violations`` is broken."""
    found = constraint_violations(df, **rules).collect()
    _raise_broken({r.rule: r.violations for r in found})


def _raise_broken(violations: dict[str, int]) -> None:
    broken = [f"{rule}: {count}" for rule, count in violations.items() if count]
    if broken:
        raise ValueError("; ".join(broken))


# Rules of the stored tables, as arguments for the functions above.
PLAYS_RULES = {
    "not_null": ["play_id", "spotify_track_uri", "played_at", "source"],
    "key": ["play_id"],
    "max_length": {"spotify_track_uri": 100, "play_quality": 20, "source": 20},
}
TRACK_STATS_RULES = {
    "not_null": [
        "play_count",
        "unique_days_played",
        "full_listen_count",
        "natural_end_count",
        "partial_count",
        "skip_count",
        "unclassified_count",
    ],
    "key": ["spotify_track_uri"],
    "max_length": {"spotify_track_uri": 100, "track_name": 500, "artist_name": 500},
}
TRACK_DATA_RULES = {"not_null": ["source_uri"], "key": ["source_uri"]}
TAG_MAPPING_RULES = {
    "not_null": ["tag_id", "spotify_track_uri"],
    "key": ["tag_id", "spotify_track_uri"],
}
