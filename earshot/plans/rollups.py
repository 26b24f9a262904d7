"""Roll-ups of any length of time from stored monthly sketches, beside the exact statistics.

A row per track and month holds counts, which add up, and mergeable sketches of its days, which don't. A
year is then folded from twelve rows a track, a year of all tracks from the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.text import present
from earshot.functions.times import month_of

URI = "spotify_track_uri"
#: Size of the sketches: the logarithm of their cells.
LG_CELLS = 12


def monthly_sketches(plays: DataFrame, lg_cells: int = LG_CELLS) -> DataFrame:
    """(month, track, plays, days): play count and sketch of the days, per track and month."""
    return (
        plays.where(present(F.col(URI)))
        .groupBy(month_of(F.col("played_at")).alias("month"), URI)
        .agg(F.count("*").alias("plays"), F.hll_sketch_agg(F.to_date("played_at").cast("string"), F.lit(lg_cells)).alias("days"))
    )


def rolled_up(months: DataFrame, by: Sequence[str | Column] = (URI,)) -> DataFrame:
    """Plays and approximate distinct days of the given groups of ``monthly_sketches``."""
    return months.groupBy(*by).agg(
        F.sum("plays").alias("plays"),
        F.hll_sketch_estimate(F.hll_union_agg("days")).alias("days_played"),
    )
