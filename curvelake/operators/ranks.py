"""Exact ranks and quantiles inside few, very large groups.

Rows are range-partitioned by group and order, so a group spreads over as many
tasks as its rows need, ties included. Only counts per range cross the group; no
task ever sorts a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.session import cut


def _with_range(df: DataFrame, by: Sequence[str], order: Sequence[str], ranges: int | None) -> DataFrame:
    """Add ``_range``: which slice of the order by group and ``order`` a row falls in.

    Bounds come from a sample of the rows; the number of slices is the session's
    shuffle partitions unless given. Materialised, so that every later read sees
    the same slices. A window over group and range then has an exchange of its own.
    """
    keys = [*by, *order]
    dealt = df.repartitionByRange(*keys) if ranges is None else df.repartitionByRange(ranges, *keys)
    return cut(dealt.withColumn("_range", F.spark_partition_id()))


def _offsets(ranged: DataFrame, by: Sequence[str], rows: Column) -> DataFrame:
    """Rows of a group before each range, and in all; one line per group and range."""
    per = ranged.groupBy(*by, "_range").agg(rows.alias("_rows"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*by, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                      F.sum("_rows").over(whole).alias("_total"))


def row_ranks(df: DataFrame, by: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Add ``rank`` (1-based, over ``order``) and ``group_rows``. ``order`` must be unique in a group."""
    ranged = _with_range(df, by, order, ranges)
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    return (ranged.withColumn("_row", F.row_number().over(inside))
            .join(_offsets(ranged, by, F.count("*")), [*by, "_range"])
            .withColumn("rank", F.col("_before") + F.col("_row"))
            .withColumnRenamed("_total", "group_rows").drop("_range", "_row", "_before"))


def value_ranks(
    df: DataFrame, by: Sequence[str], value: str, weight: str | None = None, ranges: int | None = None,
) -> DataFrame:
    """One row per group and distinct value: rows before it, its count, rows in all, average rank.

    ``weight`` names a column of row counts when equal rows were already combined.
    """
    size = F.count("*") if weight is None else F.sum(weight)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(size.alias("ties"))
    ranged = _with_range(counts, by, [value], ranges)
    inside = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("_inside", F.coalesce(F.sum("ties").over(inside), F.lit(0)))
            .join(_offsets(ranged, by, F.sum("ties")), [*by, "_range"])
            .select(*by, value, "ties", (F.col("_before") + F.col("_inside")).alias("before"),
                    F.col("_total").alias("group_rows"),
                    (F.col("_before") + F.col("_inside") + (F.col("ties") + 1) / 2.0).alias("average_rank")))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles: columns ``q0``, ``q1`` ... in the given order."""
    ranked = value_ranks(df, by, value)
    aggregates = []
    for i, p in enumerate(probabilities):
        place = (F.col("group_rows") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            hit = (F.col("before") <= at) & (at < F.col("before") + F.col("ties"))
            aggregates.append(F.max(F.when(hit, F.col(value))).alias(f"_{side}{i}"))
        aggregates.append(F.max(place - F.floor(place)).alias(f"_part{i}"))
    found = ranked.groupBy(*by).agg(*aggregates)
    return found.select(*by, *[
        (F.col(f"_lo{i}") + F.col(f"_part{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}")
        for i in range(len(probabilities))])


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks over pairwise-complete rows: ``rho, n``."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).groupBy("x", "y").agg(
            F.count("*").alias("w")).withColumn("g", F.lit(0))
    rx = value_ranks(pairs, ["g"], "x", "w").select("x", F.col("average_rank").alias("rx"))
    ry = value_ranks(pairs, ["g"], "y", "w").select("y", F.col("average_rank").alias("ry"))
    ranked = pairs.join(rx, "x").join(ry, "y")
    n = F.sum("w")
    mean = (n + 1.0) / 2.0
    sxy = F.sum(F.col("w") * F.col("rx") * F.col("ry")) - n * mean * mean
    sxx = F.sum(F.col("w") * F.col("rx") * F.col("rx")) - n * mean * mean
    syy = F.sum(F.col("w") * F.col("ry") * F.col("ry")) - n * mean * mean
    return ranked.agg((sxy / F.sqrt(sxx * syy)).alias("rho"), n.alias("n"))
