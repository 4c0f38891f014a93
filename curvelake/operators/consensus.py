"""Weighted consensus of source estimates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.operators.checks import Check, all_checks, check_table, grain_check
from curvelake.rules import AggregationRules, SourceRules

KEYS = ("run_id", "season", "canonical_player_id", "stat")


def enabled_weights(sources: Mapping[str, SourceRules]) -> dict[str, float]:
    weights = {name: rule.weight for name, rule in sorted(sources.items()) if rule.enabled and rule.weight > 0}
    if not weights:
        raise ValueError("at least one enabled source needs a positive weight")
    return weights


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in the given order. Reduced by aggregation, not by sorting groups."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("_first")).select(*keys, "_first.*").select(*df.columns)


def consensus(projections: DataFrame, sources: Mapping[str, SourceRules], rules: AggregationRules) -> DataFrame:
    """One row per run, season, player and statistic from its eligible sources.

    A single aggregation with one conditional slot per enabled source: sources
    align with their weights by name, and map-side combine bounds the shuffle.
    """
    weights = enabled_weights(sources)
    passed = F.col("quality_status") == "passed"
    values = ("mean", "sensitivity_low", "sensitivity_high")
    named = [F.max("canonical_player_name").alias("canonical_player_name")] if "canonical_player_name" in projections.columns else []
    slots = projections.groupBy(*KEYS).agg(*named, *[
        F.max(F.when(passed & (F.col("source") == s), F.col(v))).alias(f"{s}_{v}") for s in weights for v in values])

    def present(source):
        return F.col(f"{source}_mean").isNotNull()

    def over(pick, reduce_):
        return reduce_(F.array_compact(F.array(*[F.when(present(s), pick(s)) for s in weights])))

    def add(items):
        return F.aggregate(items, F.lit(0.0), lambda a, x: a + x)

    available = over(lambda s: F.lit(weights[s]), add)
    denominator = available if rules.renormalize_available_source_weights else F.lit(sum(weights.values()))
    count = over(lambda s: F.lit(1), F.size)
    enough = F.col("source_count") >= rules.minimum_sources

    def blend(v):
        return F.when(enough, over(lambda s: F.lit(weights[s]) * F.col(f"{s}_{v}"), add) / denominator)

    spread = F.col("source_range")
    return slots.select(
        *KEYS, *[c for c in ("canonical_player_name",) if named],
        F.lit("source_consensus_v1").alias("aggregation_version"),
        over(lambda s: F.lit(s), lambda a: F.array_join(a, "|")).alias("source_list"), count.alias("source_count"),
        available.alias("configured_weight_sum"),
        F.when(denominator > 0, available / denominator).otherwise(0.0).alias("effective_weight_sum"),
        F.lit("model_sensitivity_not_confidence_interval").alias("sensitivity_label"),
        *[F.col(f"{s}_{v}") for s in weights for v in values],
        *[F.lit(weights[s]).alias(f"{s}_configured_weight") for s in weights],
        *[F.when(present(s) & (denominator > 0), F.lit(weights[s]) / denominator).otherwise(0.0)
          .alias(f"{s}_effective_weight") for s in weights],
    ).select(
        "*", blend("mean").alias("consensus_mean"), blend("sensitivity_low").alias("sensitivity_low"),
        blend("sensitivity_high").alias("sensitivity_high"),
        F.when(enough, over(lambda s: F.col(f"{s}_mean"), F.array_min)).alias("minimum_source_mean"),
        F.when(enough, over(lambda s: F.col(f"{s}_mean"), F.array_max)).alias("maximum_source_mean"),
    ).withColumn("source_range", F.col("maximum_source_mean") - F.col("minimum_source_mean")).withColumn(
        "relative_disagreement", spread / F.greatest(F.abs("consensus_mean"), F.lit(1e-12))).withColumns({
            "disagreement_flag": (spread > rules.max_absolute_disagreement) | (
                F.col("relative_disagreement") > rules.max_relative_disagreement),
            "quality_status": F.when(enough, "passed").otherwise("excluded"),
            "exclusion_reason": F.when(enough, "").otherwise("minimum_sources_not_met")})


def consensus_gate(projections: DataFrame, consensus_rows: DataFrame, sources: Mapping[str, SourceRules],
                   rules: AggregationRules) -> DataFrame:
    """Known sources, unique grains, present values and eligible lineage."""
    eligible = (F.col("quality_status") == "passed") & F.col("source").isin(*enabled_weights(sources))
    finite = N.is_finite(F.col("mean")) & N.is_finite(F.col("sensitivity_low")) & N.is_finite(F.col("sensitivity_high"))
    counted = projections.agg(
        F.count_if(~F.col("source").isin(*sources)).alias("unknown"), F.count_if(eligible & ~finite).alias("invalid"))
    passed = F.col("quality_status") == "passed"
    published = consensus_rows.agg(
        F.count_if(passed).alias("published"), F.count_if(passed & (F.col("source_count") < rules.minimum_sources)).alias("thin"))
    return all_checks(
        check_table(counted, [
            Check("aggregation.known_sources", F.col("unknown") == 0, "every source is configured", details={"rows": F.col("unknown")}),
            Check("aggregation.eligible_values", F.col("invalid") == 0, "eligible values are present and finite",
                  details={"invalid_rows": F.col("invalid")})]),
        grain_check(projections, [*KEYS, "source"], "aggregation.source_projection_keys", "source grain is unique"),
        grain_check(consensus_rows, list(KEYS), "aggregation.consensus_keys", "consensus grain is unique"),
        check_table(published, [Check(
            "aggregation.eligible_lineage", (F.col("published") > 0) & (F.col("thin") == 0),
            "every consensus value has eligible sources", details={"consensus_rows": F.col("published"), "too_few_sources": F.col("thin")})]))
