"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import settle


def _stars(edges: DataFrame) -> DataFrame:
    """Large star: the larger neighbours of each node move to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("m", "u").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _folds(edges: DataFrame) -> DataFrame:
    """Small star: the smaller neighbours of each node, and the node, move to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest node of the component for each linked node.

    ``links`` has two long columns (u, v); direction, repeats, loops and nulls don't matter.
    Returns (node, root) for every node with a link to another, the root itself left out.
    Each round is written to the shared folder; the number of rounds grows with the logarithm
    of the longest chain. Only one row of counts a round reaches the driver.
    """
    edges = (
        links.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges, seen = settle(edges, "links"), None
    while True:
        state = edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        edges = settle(_folds(_stars(edges)), "links")
