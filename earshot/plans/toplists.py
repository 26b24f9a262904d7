"""Top lists from stored frequency sketches: few candidates, counted exactly, no sort of all tracks.

A sketch per day keeps the tracks that may be frequent in it, in bounded space, and sketches add up. The
sketch of a month or of the whole log names the candidates of its list, which alone are counted. Its
error has a bound, so the counts tell whether a track outside the candidates could belong into the
list; groups in which it could, as all their tracks are about equally frequent, are counted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.text import present
from earshot.functions.times import month_of
from earshot.schemas import REPORT_ROWS

URI = "spotify_track_uri"
#: Tracks that a sketch keeps.
TRACKED = 4096
#: A track that a sketch of n plays doesn't name has at most SLACK * n / TRACKED of them: the sketch's error is
#: 3.5 n over its cells, of which three quarters are used, and a track is named if it surely has more.
SLACK = 6


def daily_states(plays: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(day, plays, state): number of plays with a track and their frequency sketch, per day."""
    return (
        plays.where(present(F.col(URI)))
        .groupBy(F.to_date("played_at").alias("day"))
        .agg(F.count("*").alias("plays"), F.expr(f"approx_top_k_accumulate({URI}, {int(tracked)})").alias("state"))
    )


def month_of_day() -> Column:
    """The month of a row of ``daily_states``, as ``exact_top`` wants it for lists by month."""
    return month_of(F.col("day").cast("timestamp_ntz"))


def candidates(states: DataFrame, by: Column, tracked: int = TRACKED) -> DataFrame:
    """(group, plays, track): the tracks that the sketch of each group names, ``tracked`` at most."""
    merged = states.groupBy(by.alias("group")).agg(
        F.sum("plays").alias("plays"), F.expr(f"approx_top_k_combine(state, {int(tracked)})").alias("state")
    )
    named = F.explode(F.expr(f"approx_top_k_estimate(state, {int(tracked)})")).alias("named")
    return merged.select("group", "plays", named).select("group", "plays", F.col("named.item").alias(URI))


def exact_top(
    plays: DataFrame,
    states: DataFrame,
    group: Column | None = None,
    state_group: Column | None = None,
    rows: int = REPORT_ROWS,
    tracked: int = TRACKED,
) -> DataFrame:
    """(group, rank, track, play_count): the most played tracks of each group, equal counts in URI order.

    ``states`` are the ``daily_states`` of ``plays``; ``group`` tells the group of a play and
    ``state_group`` that of a state; without them there is one group. Equal to counting every track. An empty
    log gives no rows.
    """
    if rows > tracked:
        raise ValueError(f"{rows} rows can't be found among {tracked} tracked ones")
    group, state_group = (_whole(c) if g is None else g for g, c in ((group, URI), (state_group, "day")))
    keyed = plays.where(present(F.col(URI))).select(group.alias("group"), URI)
    named = candidates(states, state_group, tracked)
    counted = keyed.join(named, ["group", URI]).groupBy("group", URI).agg(F.max("plays").alias("plays"), F.count("*").alias("play_count"))
    top = _first(counted, rows)
    sure = counted.groupBy("group").agg(F.sum("play_count").alias("seen"))
    least = top.groupBy("group").agg(F.max("plays").alias("plays"), F.min("play_count").alias("least"), F.max("rank").alias("found"))
    clear = (F.col("found") == rows) & (F.col("least") * tracked > SLACK * F.col("plays"))
    sure = least.join(sure, "group").where(clear | (F.col("seen") == F.col("plays"))).select("group")
    rest = states.select(state_group.alias("group")).distinct().join(sure, "group", "left_anti")
    others = keyed.join(rest, "group", "left_semi").groupBy("group", URI).agg(F.count("*").alias("play_count"))
    columns: Sequence[str] = ("group", "rank", URI, "play_count")
    return top.join(sure, "group", "left_semi").select(*columns).unionByName(_first(others, rows).select(*columns))


def _whole(column: str) -> Column:
    """The one group of lists without groups; no literal, as a join on literals is planned as a nested loop."""
    return F.concat(F.lit("all"), F.substring(F.coalesce(F.col(column).cast("string"), F.lit("")), 1, 0))


def _first(counts: DataFrame, rows: int) -> DataFrame:
    """The rank filter goes below the shuffle: a task passes on ``rows`` rows of each group."""
    rank = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("play_count"), URI))
    return counts.withColumn("rank", rank).where(F.col("rank") <= rows)
