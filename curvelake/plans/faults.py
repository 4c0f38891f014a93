"""Every gate over rows with planted faults: what a failing stage looks like, with the details of each check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.operators import calibrate, checks, consensus, history, history_gates, means, publish, quotes, score
from curvelake.plans import queries as Q
from curvelake.plans import roles as R
from curvelake.plans.registry import detailed, query


def player() -> Column:
    return F.col(history.ENTITY).cast("bigint")


def user() -> Column:
    return F.regexp_extract("canonical_player_id", "[0-9]+$", 0).cast("bigint")


def spoil(rows: DataFrame, by: Column, modulus: int, faults: dict[int, tuple[str, Column]], again: int | None = None) -> DataFrame:
    """Set one column for the rows of a remainder of ``by``; rows of remainder ``again`` come twice."""
    kind = rows.withColumn("_kind", by % modulus)
    columns: dict[str, Column] = {}
    for remainder, (name, value) in faults.items():
        columns[name] = F.when(F.col("_kind") == remainder, value.cast(rows.schema[name].dataType)).otherwise(columns.get(name, F.col(name)))
    spoilt = kind.withColumns(columns)
    if again is not None:
        spoilt = spoilt.unionByName(spoilt.filter(F.col("_kind") == again))
    return spoilt.drop("_kind")


def _season_gate(spark, sf) -> DataFrame:
    late = F.col("schedule_games")
    rows = spoil(R.seasons(spark, sf), player(), 50, {
        1: ("quantity", F.lit(1e6)), 2: ("games", late + 2), 3: ("games", late + 1), 4: ("player_name", F.lit(None)), 5: ("team", F.lit(None))})
    return history_gates.season_gate(rows, R.HISTORY)


@query
def weekly_faults(spark, sf):
    """A lost season, lost ids and values, impossible counts, repeated rows; implausible seasons and missing names."""
    rows = spoil(R.weekly(spark, sf).filter("season <> 1996"), F.col("source_order"), 97, {
        1: (history.ENTITY, F.lit(None)), 2: ("quantity", F.lit(None)), 3: ("line_count", F.lit(-1.0)), 5: ("shipped_lines", F.lit(-1.0))}, again=7)
    return detailed(checks.all_checks(history_gates.weekly_gate(rows, history.merge_weeks(rows, R.HISTORY), R.HISTORY), _season_gate(spark, sf)))


@query
def fired_warnings(spark, sf):
    """The warnings of seasons that run too long or lack a name or team."""
    return checks.failed_warnings(_season_gate(spark, sf))


@query
def prediction_faults(spark, sf):
    """Features and corrections from the future, repeated keys, broken lineage, impossible outcomes and baselines."""
    target = F.col("target_season")
    rows = spoil(R.predictions(spark, sf), player(), 50, {
        1: ("max_feature_season", target), 2: ("baseline_bias_max_observation_season", target), 5: ("realized_total", F.lit(None)), 6: ("stat", F.lit("other")),
        7: ("feature_seasons", F.concat(F.lit("x|"), "feature_seasons")), 8: ("baseline_bias_exponent", F.lit(-1.0)), 9: ("realized_total", F.lit(-5.0)),
        10: ("realized_total", F.lit(2.5)), 11: ("baseline_mean", F.lit(None)), 12: ("baseline_mean", F.lit(0.0))}, again=3)
    return detailed(checks.all_checks(
        history_gates.prediction_gate(rows, R.HISTORY), calibrate.prediction_contract(rows, R.HISTORY),
        calibrate.cohort_gate(calibrate.window_rows(rows, R.HISTORY), R.HISTORY, R.CALIBRATION)))


@query
def pricing_faults(spark, sf):
    """Impossible and hidden probabilities, sides that do not add up, crossed quotes, wrong decimals."""
    book, included = F.col("source").isin(quotes.names_of(R.SOURCES, "book")), F.col("inclusion_status") == "included"
    keep = lambda name, where, value: (name, F.when(where, value).otherwise(F.col(name)))
    rows = spoil(R.priced(spark, sf), F.col("source_market_id").cast("bigint"), 40, {
        0: keep("modeling_probability", included, F.lit(1.2)), 1: keep("modeling_probability", ~included, F.lit(0.5)),
        2: ("paired_under_no_vig_probability", F.col("paired_under_no_vig_probability") + 0.01), 3: keep("market_overround", ~book, F.lit(1.0)),
        5: ("bid_probability", F.col("ask_probability") + 0.01), 7: ("source_decimal_odds", F.col("source_decimal_odds") + 0.01)})
    return detailed(quotes.pricing_gate(rows, R.SOURCES, R.PRICING))


@query
def model_faults(spark, sf):
    """Unsolved, unbounded and impossible means, quotes that should not or should have contributed, survival that rises."""
    attempted, passed, book = F.col("optimizer_converged").isNotNull(), F.col("quality_status") == "passed", F.col("source").isin(quotes.names_of(R.SOURCES, "book"))
    keep = lambda name, where, value: (name, F.when(where, value).otherwise(F.col(name)))
    projections = Q._projections(spark, sf)
    spoilt = spoil(projections, user(), 29, {
        1: keep("optimizer_converged", attempted, F.lit(False)), 2: ("sensitivity_low", F.lit(None)), 3: keep("mean", passed, F.lit(1e9)),
        5: keep("fit_error", book & attempted, F.lit(1.0)), 6: keep("logit_rmse", passed & ~book, F.lit(9.0))}, again=4)
    used = F.col("model_inclusion_status") == "included"
    fitted = used & F.col("source_projection_mean").isNotNull()
    backfilled = spoil(means.backfill_quotes(R.model_quotes(spark, sf), projections), user(), 31, {
        1: keep("modeled_probability", ~used, F.lit(0.5)), 2: ("modeled_probability", F.lit(None)),
        3: keep("modeled_probability", fitted, F.col("canonical_threshold") / 1e6), 4: ("source_projection_mean", F.col("source_projection_mean") + 100.0),
        6: ("model_exclusion_reason", F.lit("invalid_model_threshold"))})
    backfilled = backfilled.unionByName(backfilled.filter(fitted & (user() % 31 == 5)))
    dispersions = Q._historical_only(R.dispersions(spark, sf)).withColumn("final_dispersion", F.when(F.col("stat") == "quantity", -1.0).otherwise(F.col("final_dispersion")))
    return detailed(means.model_gate(spoilt, Q.cut(backfilled.select(*means.GATE_READS)), dispersions, R.SOURCES, R.MEANS))


@query
def consensus_faults(spark, sf):
    """An unknown source, values that are no numbers, repeated keys, a consensus of nobody."""
    estimates = Q._estimates(spark, sf)
    rows = spoil(estimates, user(), 29, {1: ("source", F.when(F.col("source") == "error", "nowhere").otherwise(F.col("source"))), 2: ("mean", F.lit(float("nan")))}, again=3)
    blended = spoil(consensus.consensus(estimates, R.SOURCES, R.AGGREGATION), user(), 31, {
        5: ("source_count", F.when(F.col("quality_status") == "passed", 0).otherwise(F.col("source_count")))}, again=4)
    return detailed(consensus.consensus_gate(rows, blended, R.SOURCES, R.AGGREGATION))


@query
def scoring_faults(spark, sf):
    """Repeated players, published points that do not reconcile, modes that fall, values hidden without a reason."""
    inputs = spoil(Q._consensus(spark, sf), user(), 31, {}, again=4)
    complete = F.col("partial_fpts_standard").isNotNull()
    scored = spoil(Q._scored(spark, sf), user(), 29, {
        2: ("fpts_full_ppr", F.col("fpts_full_ppr") + 1.0), 5: ("partial_fpts_full_ppr", F.col("partial_fpts_full_ppr") - 1e4),
        6: ("components_missing", F.lit(""))}, again=3)
    hidden = (user() % 29 == 6) & complete
    scored = scored.withColumn("fpts_standard", F.when(~hidden, F.col("fpts_standard")))
    return detailed(score.scoring_gate(inputs, scored, R.SCORING))


@query
def mart_faults(spark, sf):
    """Lost rows, an infinite value, a repeated header, players without a source row."""
    scored = Q.cut(Q._scored(spark, sf))
    mart = publish.projection_mart(scored, R.SCORING).filter(user() % 29 != 1)
    mart = mart.withColumn("quantity", F.when(user() % 29 == 2, float("inf")).otherwise(F.col("quantity"))).select("*", F.lit("again").alias("scoring_scope"))
    return detailed(publish.mart_gate(mart, scored, Q._estimates(spark, sf).filter(user() % 29 != 3), "projections"))
