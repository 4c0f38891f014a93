"""Rolling-origin Poisson power calibration of raw baselines.

The model is ``mean = exp(a) * raw ** b``. Recency weights depend only on the
season, so every fit (statistic, reference season, half-life) can be assembled
from sums per statistic and season. Two passes over the observations serve all
fits and all validation folds together:

1. sums of ``raw ** b`` and its log-moments on a fixed grid of exponents, from
   which each fit's exponent is located by interpolation;
2. the same sums at each fit's own exponent, for one Newton polish, the
   intercept, the objective, and the score on the following season.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.functions.numeric import half_life_weight, is_finite, pipe_join
from curvelake.functions.special import lgamma
from curvelake.operators.history import ENTITY
from curvelake.rules import HistoryRules
from curvelake.session import cut, spread

GRID_NODES = 33
# What ``rolling_calibration`` reads of the predictions.
READS = (ENTITY, "stat", "target_season", "training_eligible", "realized_total", "baseline_mean", "baseline_formula", "feature_seasons", "max_feature_season")
FIT = ["stat", "reference_season", "half_life"]


def observations(predictions: DataFrame, rules: HistoryRules) -> DataFrame:
    """Eligible rows that a calibration may learn from: log raw mean ``x`` and outcome ``y``."""
    raw, y = F.col("baseline_mean_raw"), F.col("realized_total")
    rows = predictions.filter(
        F.col("training_eligible") & is_finite(raw) & (raw > 0) & is_finite(y) & (y >= 0)
        & F.col("target_season").between(rules.calibration_start_season, rules.holdout_start - 1)
    ).select(ENTITY, "stat", F.col("target_season").alias("season"), F.log(raw).alias("x"), y.alias("y"))
    return spread(rows, ENTITY).drop(ENTITY)


def _moments(x: Column, b: Column) -> list[Column]:
    grown = F.exp(b * x)
    return [F.sum(grown).alias("s0"), F.sum(x * grown).alias("s1"), F.sum(x * x * grown).alias("s2")]


def power_fits(obs: DataFrame, rules: HistoryRules) -> DataFrame:
    """Every fit (statistic, reference season, half-life) with its score on the next season.

    ``obs`` should be materialised: it is read twice.
    """
    lo, hi = rules.power_fit.exponent_bounds
    step = (hi - lo) / (GRID_NODES - 1)
    grid = F.array(*[F.lit(lo + step * i) for i in range(GRID_NODES)])
    halves = sorted({*rules.power_fit.half_life_candidates, rules.recency_half_life_seasons})

    # Pass 1: one row per statistic, season and node.
    nodes = obs.select("stat", "season", "x", "y", F.posexplode(grid).alias("node", "b")).groupBy(
        "stat", "season", "node", "b").agg(
            F.count("*").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("y")).alias("sxy"),
            F.sum(F.when(F.col("node") == 0, lgamma(F.col("y") + 1.0))).alias("slg"),
            *_moments(F.col("x"), F.col("b")))

    # Every season trains all later reference seasons; the table is bounded by the rules.
    references = F.explode(F.sequence(F.col("season"), F.lit(rules.holdout_start - 1)))
    spread = nodes.select("*", references.alias("reference_season")).select(
        "*", F.explode(F.array(*[F.lit(h) for h in halves])).alias("half_life"))
    w = half_life_weight(F.col("reference_season") - F.col("season"), F.col("half_life"))
    sums = spread.groupBy(*FIT, "node", "b").agg(
        F.sum("n").alias("n"), F.sum(w * F.col("n")).alias("wn"), F.sum(w * F.col("sy")).alias("wy"),
        F.sum(w * F.col("sxy")).alias("wxy"), F.sum(w * F.col("slg")).alias("wlg"),
        *[F.sum(w * F.col(s)).alias(s) for s in ("s0", "s1", "s2")],
        F.array_sort(F.collect_set("season")).alias("seasons"))
    mean_log = F.col("s1") / F.col("s0")
    located = sums.withColumns({
        "g": mean_log - F.try_divide("wxy", "wy"),
        "dg": F.col("s2") / F.col("s0") - mean_log * mean_log})
    packed = located.groupBy(*FIT).agg(
        F.array_sort(F.collect_list(F.struct("node", "b", "g", "dg"))).alias("nodes"),
        *[F.max(c).alias(c) for c in ("n", "wn", "wy", "wxy", "wlg")], F.first("seasons").alias("seasons"))
    # The score g rises with the exponent: bracket its zero between two nodes, then
    # solve the cubic that matches g and its slope at both.
    below = F.size(F.filter("nodes", lambda s: s["g"] <= 0))
    bracketed = packed.withColumn("below", below).withColumns({
        "left": F.get("nodes", F.greatest(F.lit(0), F.least(F.col("below") - 1, F.lit(GRID_NODES - 2)))),
        "right": F.get("nodes", F.greatest(F.lit(1), F.least(F.col("below"), F.lit(GRID_NODES - 1))))})
    g0, g1 = F.col("left.g"), F.col("right.g")
    d0, d1 = F.col("left.dg") * step, F.col("right.dg") * step
    bracketed = bracketed.withColumn("cubic", F.struct(
        g0.alias("c0"), d0.alias("c1"), (3.0 * (g1 - g0) - 2.0 * d0 - d1).alias("c2"), (2.0 * (g0 - g1) + d0 + d1).alias("c3")))
    c0, c1, c2, c3 = (F.col(f"cubic.{n}") for n in ("c0", "c1", "c2", "c3"))

    def newton(u: Column, _: Column) -> Column:
        value, slope = c0 + c1 * u + c2 * u * u + c3 * u * u * u, c1 + 2.0 * c2 * u + 3.0 * c3 * u * u
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), u - F.coalesce(F.try_divide(value, slope), F.lit(0.0))))

    inside = F.aggregate(F.sequence(F.lit(1), F.lit(5)), F.coalesce(F.try_divide(g0, g0 - g1), F.lit(0.5)), newton)
    start = bracketed.withColumn("b", F.when(F.col("below") == 0, F.lit(lo)).when(
        F.col("below") == GRID_NODES, F.lit(hi)).otherwise(F.col("left.b") + inside * step)).drop(
            "nodes", "below", "left", "right", "cubic")

    # Pass 2: sums at each fit's own exponent, up to and including the next season.
    matched = obs.join(F.broadcast(start.select(*FIT, "b")), "stat").filter(
        F.col("season") <= F.col("reference_season") + 1)
    at_fit = matched.groupBy(*FIT, "b", "season").agg(
        F.count("*").alias("rows"), F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.sum(lgamma(F.col("y") + 1.0)).alias("slg"), *_moments(F.col("x"), F.col("b")))
    trains = F.col("season") <= F.col("reference_season")
    w = half_life_weight(F.col("reference_season") - F.col("season"), F.col("half_life"))
    polished = at_fit.groupBy(*FIT).agg(
        *[F.sum(F.when(trains, w * F.col(s))).alias(s) for s in ("s0", "s1", "s2")],
        *[F.sum(F.when(~trains, F.col(s))).alias(f"next_{s}") for s in ("rows", "sy", "sxy", "slg", "s0", "s1", "s2")])
    joined = start.join(polished, FIT)
    g = F.col("s1") / F.col("s0") - F.col("wxy") / F.col("wy")
    dg = F.col("s2") / F.col("s0") - F.pow(F.col("s1") / F.col("s0"), 2)
    delta = F.when((F.col("b") <= lo) | (F.col("b") >= hi), F.lit(0.0)).otherwise(F.coalesce(F.try_divide(-g, dg), F.lit(0.0)))
    delta = F.greatest(F.lit(lo) - F.col("b"), F.least(F.lit(hi) - F.col("b"), delta))

    def shifted(prefix):
        return F.col(f"{prefix}s0") + F.col(f"{prefix}s1") * F.col("delta") + F.col(f"{prefix}s2") * F.col("delta") * F.col("delta") / 2.0

    tolerance = max(1e-6, (hi - lo) * 1e-6)
    a, b = F.col("intercept"), F.col("exponent")
    return (
        joined.withColumn("delta", delta)
        .withColumn("exponent", F.col("b") + F.col("delta"))
        .withColumn("intercept", F.log(F.try_divide(F.col("wy"), shifted(""))))
        .withColumns({
            "bound_hit": (b - lo <= tolerance) | (hi - b <= tolerance),
            "converged": is_finite(a) & is_finite(b) & (F.abs(a) < 20.0) & (F.abs(F.col("delta")) < 1e-3),
            "objective_poisson_nll": F.col("n") / F.col("wn") * (
                F.col("wy") - a * F.col("wy") - b * F.col("wxy") + F.col("wlg")),
            "next_nll": F.exp(a) * shifted("next_") - a * F.col("next_sy") - b * F.col("next_sxy") + F.col("next_slg"),
        })
        .select(*FIT, "intercept", "exponent", "converged", "bound_hit", "objective_poisson_nll",
                F.col("n").alias("training_player_seasons"), F.col("seasons").alias("training_seasons"),
                F.col("next_rows").alias("next_rows"), "next_nll"))


def select_half_lives(fits: DataFrame, rules: HistoryRules) -> DataFrame:
    """Half-life per (statistic, reference season) by nested rolling-origin score.

    A fold trains up to one season and scores the next. A candidate with a failed
    fold is out; too few folds fall back to the configured half-life.
    """
    power = rules.power_fit
    usable = F.size("training_seasons") >= power.minimum_seasons
    folds = fits.filter(F.col("half_life").isin(*power.half_life_candidates) & usable & F.col("next_rows").isNotNull())
    failed = ~F.col("converged") | F.col("bound_hit") | ~is_finite(F.col("next_nll"))
    references = fits.filter(usable).select("stat", "reference_season").distinct()
    scored = references.join(F.broadcast(folds.select(
        "stat", (F.col("reference_season") + 1).alias("validation_season"), "half_life",
        F.coalesce(failed, F.lit(True)).alias("failed"), "next_rows", "next_nll")), "stat").filter(
            F.col("validation_season") <= F.col("reference_season")).groupBy(
                "stat", "reference_season", "half_life").agg(
                    (F.sum("next_nll") / F.sum("next_rows")).alias("score"),
                    F.max("failed").alias("failed"),
                    F.array_sort(F.collect_set("validation_season")).alias("validation_seasons"))
    enough = F.size("validation_seasons") >= power.minimum_validation_seasons
    ranked = F.when(enough & ~F.col("failed"), F.struct("score", "half_life"))
    chosen = scored.groupBy("stat", "reference_season").agg(
        F.min(ranked).alias("best"), F.max(enough).alias("enough"),
        F.max(F.when(enough, F.col("validation_seasons"))).alias("validation_seasons"))
    default = F.when(F.coalesce("enough", F.lit(False)), F.col("best.half_life")).otherwise(
        F.lit(float(rules.recency_half_life_seasons)))
    return references.join(chosen, ["stat", "reference_season"], "left").select(
        "stat", "reference_season", default.alias("half_life"),
        F.when(F.col("enough"), F.col("best.score")).alias("selection_score"),
        F.coalesce("validation_seasons", F.array().cast("array<int>")).alias("validation_seasons"))


def rolling_calibration(predictions: DataFrame, rules: HistoryRules) -> DataFrame:
    """Calibrate raw baselines season by season, frozen before the holdout."""
    raw = predictions.withColumn("baseline_mean_raw", F.col("baseline_mean"))
    obs = cut(observations(raw, rules))
    fits = cut(power_fits(obs, rules))
    chosen = select_half_lives(fits, rules).join(fits, FIT)
    # Bounded by the rules: statistics times seasons.
    targets = chosen.select(
        "*", F.explode(F.filter(
            F.sequence(F.lit(rules.calibration_start_season), F.lit(rules.latest_completed_season)),
            lambda t: F.least(t - 1, F.lit(rules.holdout_start - 1)) == F.col("reference_season"),
        )).alias("target_season")).withColumnRenamed("stat", "fit_stat").withColumnRenamed("target_season", "fit_target")
    joined = raw.join(F.broadcast(targets), (F.col("stat") == F.col("fit_stat")) & (
        F.col("target_season") == F.col("fit_target")) & (F.col("baseline_mean_raw") > 0), "left")
    fitted = F.col("fit_stat").isNotNull()

    def when_fitted(value, otherwise):
        return F.when(fitted, value).otherwise(otherwise)

    lineage = F.array_sort(F.array_union(
        F.transform(F.filter(F.split("feature_seasons", r"\|"), lambda s: s != ""), lambda s: s.cast("int")),
        F.coalesce("training_seasons", F.array().cast("array<int>"))))
    none = F.lit(None).cast("double")
    return joined.withColumns({
        "baseline_mean": when_fitted(
            F.exp(F.col("intercept") + F.col("exponent") * F.log("baseline_mean_raw")), F.col("baseline_mean_raw")),
        "baseline_formula": when_fitted(
            F.lit("recency_weighted_player_plus_prior_position_cohort_rolling_power_poisson_v2"), F.col("baseline_formula")),
        "baseline_bias_method": when_fitted(F.lit(rules.power_fit.method), F.lit("identity_insufficient_history")),
        "baseline_bias_intercept": when_fitted(F.col("intercept"), F.lit(0.0)),
        "baseline_bias_exponent": when_fitted(F.col("exponent"), F.lit(1.0)),
        "baseline_bias_training_player_seasons": when_fitted(F.col("training_player_seasons"), F.lit(0)),
        "baseline_bias_training_seasons": when_fitted(pipe_join(F.col("training_seasons")), F.lit("")),
        "baseline_bias_max_observation_season": F.array_max("training_seasons"),
        "baseline_bias_objective_poisson_nll": F.col("objective_poisson_nll"),
        "baseline_bias_recency_half_life_seasons": when_fitted(F.col("half_life"), none),
        "baseline_bias_selection_validation_seasons": when_fitted(pipe_join(F.col("validation_seasons")), F.lit("")),
        "baseline_bias_selection_poisson_nll_per_player_season": F.col("selection_score"),
        "baseline_bias_optimizer_converged": when_fitted(F.col("converged"), F.lit(False)),
        "baseline_bias_bound_hit": when_fitted(F.col("bound_hit"), F.lit(False)),
        "feature_seasons": when_fitted(pipe_join(lineage), F.col("feature_seasons")),
        "max_feature_season": when_fitted(F.array_max(lineage), F.col("max_feature_season")),
    }).drop("fit_stat", "fit_target", "reference_season", "half_life", "selection_score", "validation_seasons",
            "intercept", "exponent", "converged", "bound_hit", "objective_poisson_nll", "training_player_seasons",
            "training_seasons", "next_rows", "next_nll")
