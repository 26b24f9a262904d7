"""Cleaning steps of the raw history."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.text import strip


def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case column names, spaces to underscores.

    Columns that end up with one name are merged, first non-NULL value wins.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for position, name in enumerate(df.columns):
        groups[normalize_name(name)].append(f"_c{position}")
    numbered = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return numbered.select(
        *[F.coalesce(*[F.col(c) for c in cols]).alias(name) for name, cols in groups.items()]
    )


def non_null_counts(df: DataFrame) -> list:
    """One aggregate per column; usable in ``agg`` and in ``observe``."""
    return [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are NULL in every row. Runs one aggregation over ``df``."""
    counts = df.agg(*non_null_counts(df)).first().asDict()
    return df.select(*[f"`{c}`" for c in df.columns if counts[c] > 0])


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip whitespace from every string column."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            strip(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, NULLs equal; copies fold before the shuffle."""
    return df.dropDuplicates()


def clean(df: DataFrame) -> DataFrame:
    """All cleaning steps in order."""
    return drop_duplicate_rows(trim_strings(drop_empty_columns(normalize_columns(df))))
