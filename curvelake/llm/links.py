"""Groups of linked nodes by star contraction, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import written


def _stars(edges: DataFrame, upward: bool) -> DataFrame:
    """Hang the larger (``upward``) or the smaller neighbours of each node onto its least neighbour."""
    if upward:
        # Both directions: every node meets its whole neighbourhood, larger ones move to the least.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        moved = low.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the component is its least node.

    Large-star and small-star steps alternate until every node hangs on the least node of its
    group; each step is a written table, so a lost executor repeats one step at most. No node's
    neighbours are gathered in one row.
    """
    current = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # Done when no node both hangs on another and has others hanging on it, and each hangs once.
        hubs = current.select("b").distinct()
        open_ends = current.join(hubs.withColumnRenamed("b", "a"), "a", "left_semi").limit(1).count()
        twice = current.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
        if not open_ends and not twice:
            break
        current = written(_stars(_stars(current, True), False))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b"), F.col("b")).distinct())
