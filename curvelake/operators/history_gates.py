"""Gates on weekly history, season totals and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.operators.checks import Check, all_checks, check_table, grain_check, missing_values
from curvelake.operators.history import ENTITY, missingness
from curvelake.rules import HistoryRules

# What ``prediction_gate`` reads of the calibrated predictions.
PREDICTION_READS = (
    "target_season", ENTITY, "stat", "training_eligible", "max_feature_season", "baseline_bias_method", "baseline_bias_intercept", "baseline_bias_exponent",
    "baseline_bias_recency_half_life_seasons", "baseline_bias_max_observation_season")


def weekly_gate(weekly: DataFrame, merged: DataFrame, rules: HistoryRules) -> DataFrame:
    """Ids, target values and opportunities of the rows, and duplicates of the merged weeks."""
    def bad(stat):
        wrong = F.col(stat).isNull() | ~N.is_finite(F.col(stat))
        return wrong if stat in rules.signed_stats else wrong | (F.col(stat) < 0)

    counted = weekly.agg(
        F.count("*").alias("rows"), F.count_if(F.col(ENTITY).isNull()).alias("no_id"),
        *[F.count_if(bad(s)).alias(f"bad_{s}") for s in rules.stats],
        *[F.count_if(F.col(o).isNotNull() & (~N.is_finite(F.col(o)) | (F.col(o) < 0))).alias(f"bad_{o}")
          for o in rules.opportunities])
    checks = check_table(counted, [
        Check("historical.regular_season_rows", F.col("rows") > 0, "rows of the configured season type exist",
              details={"rows": F.col("rows")}),
        Check("historical.player_ids_present", F.col("no_id") == 0, "every row has a player id",
              details={"missing_rows": F.col("no_id")}),
        *[Check(f"historical.target_values_valid.{s}", F.col(f"bad_{s}") == 0,
                "counting values are present, finite and of a valid sign", details={"rows": F.col(f"bad_{s}")})
          for s in rules.stats],
        *[Check(f"historical.opportunity_values_valid.{o}", F.col(f"bad_{o}") == 0,
                "opportunities are finite and non-negative", details={"rows": F.col(f"bad_{o}")})
          for o in rules.opportunities]])
    duplicates = merged.agg(
        F.count("*").alias("rows"), F.count_if("exact_duplicate").alias("exact"),
        F.count_if("conflicting").alias("conflicting"), F.count_if(F.col("merged_rows") > 1).alias("merged"))
    unique = check_table(duplicates, [Check(
        "historical.weekly_keys_unique", (F.col("exact") == 0) & (F.col("conflicting") == 0),
        "weekly keys hold neither exact duplicates nor conflicting identities",
        details={"rows": F.col("rows"), "duplicate_groups_aggregated": F.col("merged"),
                 "exact_duplicates": F.col("exact"), "conflicting": F.col("conflicting")})])
    seasons = list(range(rules.ingest_start_season, rules.latest_completed_season + 1))
    absent = missing_values(weekly, seasons, "season").agg(
        F.count("*").alias("n"), N.pipe_join(F.array_sort(F.collect_list("season"))).alias("missing"))
    complete = check_table(absent, [Check(
        "historical.seasons_complete", F.col("n") == 0, "every configured season is present",
        details={"missing": F.col("missing")})])
    return all_checks(checks, unique, complete)


def season_gate(seasons: DataFrame, rules: HistoryRules) -> DataFrame:
    """Plausible totals, schedule lengths, and missing descriptors (warnings)."""
    counted = seasons.agg(
        F.count("*").alias("rows"),
        *[F.count_if((F.col(s) > rules.plausible_maximum[s]) | (F.lit(s not in rules.signed_stats) & (F.col(s) < 0)))
          .alias(f"bad_{s}") for s in rules.stats],
        F.count_if(F.col("games") > F.col("schedule_games") + 1).alias("impossible"),
        F.count_if(F.col("games") > F.col("schedule_games")).alias("long_seasons"))
    missing = missingness(seasons, ["player_name", "team", "position"])
    return all_checks(
        check_table(counted, [
            *[Check(f"historical.implausible_totals.{s}", F.col(f"bad_{s}") == 0,
                    "season totals are within plausible limits", details={"rows": F.col(f"bad_{s}")})
              for s in rules.stats],
            Check("historical.schedule_lengths", F.col("impossible") == 0,
                  "games exceed the schedule by at most one", details={"rows": F.col("impossible")}),
            Check("historical.player_schedule_exceptions", F.col("long_seasons") == 0,
                  "games stay within the schedule", "warning", {"rows": F.col("long_seasons")})]),
        check_table(missing, [Check(
            F.concat(F.lit("historical.missingness."), F.col("column_name")), F.col("missing_rate") == 0,
            "descriptor is always present", "warning", {"missingness_rate": F.col("missing_rate")})]))


def prediction_gate(predictions: DataFrame, rules: HistoryRules) -> DataFrame:
    """Unique grain, no look-ahead, frozen holdout calibration, and cohort sizes."""
    target = F.col("target_season")
    checked = predictions.agg(
        F.count("*").alias("rows"), F.count_if(F.col("max_feature_season") >= target).alias("leaks"),
        F.count_if(F.col("baseline_bias_max_observation_season") >= target).alias("fit_leaks"))
    holdout = predictions.filter(
        (target >= rules.holdout_start) & (F.col("baseline_bias_method") == rules.power_fit.method))
    parameters = ("baseline_bias_intercept", "baseline_bias_exponent", "baseline_bias_recency_half_life_seasons")
    varies = [F.min(c) != F.max(c) for c in parameters]
    frozen = holdout.groupBy("stat").agg(
        (varies[0] | varies[1] | varies[2]).alias("varies"),
        F.max("baseline_bias_max_observation_season").alias("last"),
        F.count_if(F.col("baseline_bias_max_observation_season").isNull()).alias("unknown"),
    ).agg(F.count_if(F.col("varies") | (F.col("unknown") > 0) | (F.col("last") > rules.holdout_start - 1)).alias("thawed"))
    sizes = predictions.groupBy("stat").agg(F.count_if("training_eligible").alias("eligible"))
    return all_checks(
        grain_check(predictions, ["target_season", ENTITY, "stat"], "historical.output_keys_unique",
                    "prediction keys are unique"),
        check_table(checked, [
            Check("historical.no_lookahead", F.col("leaks") == 0, "features precede their target season",
                  details={"rows": F.col("leaks")}),
            Check("historical.baseline_bias_no_lookahead", F.col("fit_leaks") == 0,
                  "calibration precedes its target season", details={"rows": F.col("fit_leaks")})]),
        check_table(frozen, [Check(
            "historical.holdout_mean_correction_frozen", F.col("thawed") == 0,
            "calibration is fitted before and frozen across the holdout", details={"stats": F.col("thawed")})]),
        check_table(sizes, [Check(
            F.concat(F.lit("historical.cohort_size."), F.col("stat")),
            F.col("eligible") >= rules.minimum_player_seasons_per_stat, "enough eligible player seasons",
            details={"eligible_player_seasons": F.col("eligible")})]))
