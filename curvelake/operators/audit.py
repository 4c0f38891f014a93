"""Audit of published estimates: agreement, liquidity, disagreement, funnels, rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.functions.special import beta_tail
from curvelake.operators.consensus import keep_first
from curvelake.operators.ranks import exact_quantiles, spearman

PLAYER_STAT = ["canonical_player_id", "stat"]


def eligible_means(projections: DataFrame) -> DataFrame:
    return projections.filter((F.col("quality_status") == "passed") & F.col("mean").isNotNull())


def pivot_sources(projections: DataFrame, sources: Sequence[str]) -> DataFrame:
    """One row per player and statistic with each source's mean; the source list is given, not collected."""
    return eligible_means(projections).groupBy(*PLAYER_STAT).pivot("source", list(sources)).agg(F.max("mean"))


def pair_rows(pivot: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows where both sources of a pair have a mean, with their differences."""
    both = F.array(*[F.struct(F.lit(f"{a}|{b}").alias("pair"), F.col(a).alias("left"), F.col(b).alias("right")) for a, b in pairs])
    rows = pivot.select(*PLAYER_STAT, F.inline(both)).filter(F.col("left").isNotNull() & F.col("right").isNotNull())
    left, right = F.col("left"), F.col("right")
    return rows.withColumns({
        "symmetric_abs_difference": N.symmetric_abs_difference(left, right),
        "right_vs_left": N.relative_difference(right, left), "ratio": right / left})


def pair_agreement(rows: DataFrame) -> DataFrame:
    """Overlap, correlation, exact median absolute difference and mean signed difference per pair."""
    summary = rows.groupBy("pair").agg(
        F.count("*").alias("overlap"), F.corr("left", "right").alias("correlation"),
        F.avg("right_vs_left").alias("mean_signed_difference"))
    medians = exact_quantiles(rows, ["pair"], "symmetric_abs_difference", [0.5])
    return summary.join(medians.withColumnRenamed("q0", "median_abs_difference"), "pair")


def pair_agreement_by_stat(rows: DataFrame) -> DataFrame:
    by = ["pair", "stat"]
    difference = exact_quantiles(rows, by, "symmetric_abs_difference", [0.5]).withColumnRenamed("q0", "median_abs_difference")
    ratio = exact_quantiles(rows, by, "ratio", [0.5]).withColumnRenamed("q0", "median_right_to_left_ratio")
    return rows.groupBy(*by).agg(F.count("*").alias("overlap")).join(difference, by).join(ratio, by).withColumn(
        "stat_label", N.title_label(F.col("stat")))


def curve_liquidity(quotes: DataFrame) -> DataFrame:
    """Liquidity of each curve's contributing quotes.

    Spreads are prices in ticks, so a median keeps at most one counter per tick.
    """
    return quotes.groupBy(*PLAYER_STAT).agg(
        F.count("*").alias("contributing_quotes"), F.sum("volume").alias("total_volume"),
        F.sum("open_interest").alias("total_open_interest"), F.min("open_interest").alias("minimum_open_interest"),
        F.sum("volume_24h").alias("volume_24h"), F.median("spread").alias("median_spread"),
        F.max("spread").alias("maximum_spread"), F.min("min_top_size").alias("minimum_top_size"))


def with_liquidity(rows: DataFrame, liquidity: DataFrame) -> DataFrame:
    return rows.join(liquidity, PLAYER_STAT, "left")


def disagreement_rate(consensus: DataFrame, source: str) -> DataFrame:
    """Flags and rate among published rows with and without a source."""
    has = F.array_contains(F.split("source_list", r"\|"), source)
    published = consensus.filter("quality_status = 'passed'")
    return published.groupBy(has.alias("has_source")).agg(
        F.count("*").alias("rows"), F.count_if("disagreement_flag").alias("flags"),
        F.avg(F.col("disagreement_flag").cast("double")).alias("rate"))


def line_ratios(quotes: DataFrame) -> DataFrame:
    """Median mean-to-threshold ratio and overround per source and statistic."""
    by = ["source", "stat"]
    rows = quotes.filter("inclusion_status = 'included'").withColumn(
        "ratio", F.col("source_projection_mean") / F.col("canonical_threshold"))
    counted = rows.groupBy(*by).agg(F.count("*").alias("quotes"))
    ratio = exact_quantiles(rows, by, "ratio", [0.5]).withColumnRenamed("q0", "median_mean_to_threshold")
    over = exact_quantiles(rows, by, "market_overround", [0.5]).withColumnRenamed("q0", "median_overround")
    return counted.join(ratio, by, "left").join(over, by, "left").withColumns({
        "source_label": N.title_label(F.col("source")), "stat_label": N.title_label(F.col("stat"))})


def three_source_rows(pivot: DataFrame, consensus: DataFrame, books: tuple[str, str], contract: str) -> DataFrame:
    """Rows that all three sources cover: contract and consensus against the books' mean."""
    covered = pivot.dropna(subset=[*books, contract])
    book = (F.col(books[0]) + F.col(books[1])) / 2.0
    published = consensus.select(*PLAYER_STAT, "consensus_mean", "disagreement_flag")
    return covered.join(published, PLAYER_STAT).withColumn("book_mean", book).withColumns({
        "contract_vs_books": N.relative_difference(F.col(contract), F.col("book_mean")),
        "consensus_vs_books": N.relative_difference(F.col("consensus_mean"), F.col("book_mean")),
    }).withColumn("absolute_contract_vs_books", F.abs("contract_vs_books"))


def three_source_by_stat(rows: DataFrame) -> DataFrame:
    out = rows.groupBy("stat").agg(F.count("*").alias("overlaps"), F.count_if("disagreement_flag").alias("disagreement_flags"))
    for column, name in (("contract_vs_books", "median_contract_vs_books"),
                         ("absolute_contract_vs_books", "median_abs_contract_vs_books"),
                         ("consensus_vs_books", "median_consensus_shift")):
        out = out.join(exact_quantiles(rows, ["stat"], column, [0.5]).withColumnRenamed("q0", name), "stat", "left")
    return out.withColumn("stat_label", N.title_label(F.col("stat")))


def rank_correlation(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman's rho with its two-sided Student-t p-value."""
    rho = spearman(rows, x, y)
    df = (F.col("n") - 2).cast("double")
    # P(|T| > t) = I_{df / (df + t^2)}(df / 2, 1 / 2), and df / (df + t^2) = 1 - rho^2.
    return rho.withColumn("p_value", beta_tail(df / 2.0, F.lit(0.5), 1.0 - F.col("rho") * F.col("rho")))


def contract_funnel(quotes: DataFrame, projections: DataFrame, dispersions: DataFrame, source: str) -> DataFrame:
    """Raw quotes, priced quotes, contributing quotes, eligible curves, updated statistics."""
    mine = quotes.filter(F.col("source") == source)
    counts = mine.agg(
        F.count("*").alias("raw_quotes"), F.count_if(F.col("inclusion_status") == "included").alias("priced_quotes"),
        F.count_if(F.col("source_projection_quality_status") == "passed").alias("contributing_quotes"))
    curves = eligible_means(projections).filter(F.col("source") == source).agg(
        F.count("*").alias("eligible_curves"), F.count_if(F.col("eligible_quote_count") == 1).alias("single_threshold_curves"))
    updated = dispersions.agg(F.count_if(F.col("dispersion_source") != "historical_only").alias("dispersion_updates"))
    # Three one-row tables side by side.
    wide = counts.withColumn("_k", F.lit(1)).join(curves.withColumn("_k", F.lit(1)), "_k").join(
        updated.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return wide.unpivot([], wide.columns, "stage", "count")


def headline_counts(consensus: DataFrame) -> DataFrame:
    passed = F.col("quality_status") == "passed"
    single = passed & (F.col("source_count") == 1)
    return consensus.agg(
        F.count_if(passed).alias("published_rows"), F.count_if(single).alias("single_source_rows"),
        (F.count_if(single) / F.count_if(passed)).alias("single_source_rate"),
        F.count_if(passed & F.col("disagreement_flag")).alias("disagreement_rows"))


def top_rows(rows: DataFrame, score: str, n: int = 15, tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` highest scores; ties by the given columns."""
    return rows.filter(F.col(score).isNotNull()).orderBy(F.col(score).desc(), *tie).limit(n)


def player_names(projections: DataFrame) -> DataFrame:
    """One name and position per player."""
    named = projections.select("canonical_player_id", "canonical_player_name", "canonical_position")
    return keep_first(named, ["canonical_player_id"], ["canonical_player_name", "canonical_position"])


def with_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    return rows.drop("canonical_player_name").join(names, "canonical_player_id", "left")


def source_skew_seconds(snapshots: DataFrame) -> DataFrame:
    taken = F.unix_micros(N.parse_utc(F.col("snapshot_utc")))
    return snapshots.agg(((F.max(taken) - F.min(taken)) / 1e6).alias("source_skew_seconds"))


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose result tables to SQL under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
