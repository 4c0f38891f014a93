"""Means from current quotes: shared dispersion update, source estimates, sensitivity, gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.functions.special import (
    curve_cost_profile, fit_curve, invert_log_mean, leave_one_out, nb_survival,
)
from curvelake.operators.checks import Check, all_checks, check_table, grain_check
from curvelake.operators.curves import curve_arrays, curve_sizes, fit_large, leave_one_out_large, split_by_size
from curvelake.operators.minimize import zoom_minimum
from curvelake.operators.quotes import names_of
from curvelake.rules import MeanRules, SourceRules
from curvelake.session import cut

GROUP = ["run_id", "season", "canonical_player_id", "stat", "source"]
CURVE = ["stat", "canonical_player_id"]
# What ``model_gate`` reads of the quotes.
GATE_READS = (
    *GROUP, "canonical_threshold", "inclusion_status", "model_inclusion_status", "model_exclusion_reason", "modeling_probability", "modeled_probability",
    "source_projection_mean", "source_projection_quality_status")


def _by_stat(bounds: Mapping[str, tuple[float, float]], side: int) -> Column:
    table = F.create_map(*[x for stat, b in bounds.items() for x in (F.lit(stat), F.lit(float(b[side])))])
    return F.try_element_at(table, F.col("stat"))


def _bounded(df: DataFrame, rules: MeanRules) -> DataFrame:
    return df.withColumns({"lo": _by_stat(rules.mean_bounds, 0), "hi": _by_stat(rules.mean_bounds, 1)})


def included(quotes: DataFrame) -> DataFrame:
    """Model-eligible quotes as ``k`` and ``p``."""
    return quotes.filter("model_inclusion_status = 'included'").withColumns(
        {"k": F.col("canonical_threshold").cast("double"), "p": F.col("modeling_probability")})


def duplicate_thresholds(quotes: DataFrame) -> DataFrame:
    """Statistics whose eligible curves repeat a threshold within one source."""
    return included(quotes).groupBy(*GROUP, "k").agg(F.count("*").alias("n")).filter("n > 1").groupBy("stat").agg(
        F.sum("n").alias("duplicate_rows"))


# --- fits of many curves --------------------------------------------------------------

def fit_curves(quotes: DataFrame, keys: Sequence[str], rules: MeanRules, holdout: bool = True) -> DataFrame:
    """Mean, residuals and leave-one-out error per curve of rows ``keys, k, p, r, lo, hi``."""
    small, large = split_by_size(quotes, keys, rules.max_curve_quotes_per_task)
    return _fit_small(small, keys, holdout).unionByName(_fit_large(large, keys, holdout))


def _fit_small(quotes: DataFrame, keys: Sequence[str], holdout: bool) -> DataFrame:
    arrays = curve_arrays(quotes, [*keys, "r", "lo", "hi"])
    args = ("ks", "ps", "r", "lo", "hi")
    columns = [F.size("ks").cast("long").alias("quotes"), fit_curve(*args).alias("_fit")]
    if holdout:
        columns.append(leave_one_out(*args).alias("_out"))
    fitted = arrays.select(*keys, *columns)
    out = [F.col("_out.count").alias("holdout_count"), F.col("_out.failed").alias("holdout_failed_fits"),
           F.col("_out.logit_mae").alias("holdout_logit_mae")] if holdout else []
    return fitted.select(*keys, "quotes", "_fit.*", *out)


def _fit_large(quotes: DataFrame, keys: Sequence[str], holdout: bool) -> DataFrame:
    # Nearly always empty: the check costs one count and saves the rounds.
    empty = quotes.limit(1).count() == 0
    if empty:
        return _fit_small(quotes.limit(0), keys, holdout)
    fits = cut(fit_large(quotes, keys))
    sizes = quotes.groupBy(*keys).agg(F.count("*").alias("quotes"))
    fitted = sizes.join(fits, list(keys))
    if holdout:
        out = leave_one_out_large(quotes, keys, fits).select(
            *keys, F.col("count").alias("holdout_count"), F.col("failed").alias("holdout_failed_fits"),
            F.col("logit_mae").alias("holdout_logit_mae"))
        fitted = fitted.join(out, list(keys))
    return fitted


def shared_dispersion(quotes: DataFrame, priors: DataFrame, rules: MeanRules) -> DataFrame:
    """One log-dispersion per statistic and variant, with every curve's mean profiled out.

    ``quotes`` has ``stat, canonical_player_id, k, p``. ``priors`` has one row per
    statistic and variant: ``stat, variant, prior_log, prior_sd`` (a NULL sd means no prior).
    """
    quotes = _bounded(quotes.select(*CURVE, "k", "p"), rules)
    small, large = split_by_size(quotes, CURVE, rules.max_curve_quotes_per_task)
    arrays = cut(curve_arrays(small, [*CURVE, "lo", "hi"]).withColumnsRenamed({"lo": "mean_lo", "hi": "mean_hi"}))
    large = cut(large.withColumnsRenamed({"lo": "mean_lo", "hi": "mean_hi"}))
    has_large = large.limit(1).count() > 0
    by = ["stat", "variant"]
    # Bounded by the rules: statistics times variants.
    brackets = priors.withColumns({"lo": F.log(_by_stat(rules.dispersion_bounds, 0)), "hi": F.log(_by_stat(rules.dispersion_bounds, 1))})

    def cost_rows(state: DataFrame) -> DataFrame:
        # Variants at the same bracket share its profile, which does not know their priors.
        grids = state.groupBy("stat", "lo", "hi", "grid").agg(F.collect_list("variant").alias("variants"))
        # Outer: a plain explode would evaluate the profile again in a filter on its size.
        profiles = arrays.join(F.broadcast(grids), "stat").select("stat", "variants", "lo", "hi", F.posexplode_outer(
            curve_cost_profile("ks", "ps", "grid", "mean_lo", "mean_hi")).alias("node", "cost"))
        costs = profiles.groupBy("stat", "variants", "lo", "hi", "node").agg(F.sum("cost").alias("cost")).select(
            "stat", F.explode("variants").alias("variant"), "lo", "hi", "node", "cost")
        penalty = state.join(priors.filter("prior_sd IS NOT NULL"), by).select(
            *by, "lo", "hi", "prior_log", "prior_sd", F.posexplode("grid").alias("node", "log_r")).select(
                *by, "lo", "hi", "node", (0.5 * F.pow((F.col("log_r") - F.col("prior_log")) / F.col("prior_sd"), 2)).alias("cost"))
        rows = costs.unionByName(penalty)
        if has_large:
            nodes = large.join(F.broadcast(state), "stat").select(
                *by, "lo", "hi", "canonical_player_id", "k", "p", "mean_lo", "mean_hi", F.posexplode("grid").alias("node", "log_r"))
            fits = fit_large(nodes.select(
                *by, "canonical_player_id", "node", F.col("lo").alias("bracket_lo"), F.col("hi").alias("bracket_hi"), "k", "p",
                F.exp("log_r").alias("r"), F.col("mean_lo").alias("lo"), F.col("mean_hi").alias("hi")),
                [*by, "canonical_player_id", "node", "bracket_lo", "bracket_hi"])
            rows = rows.unionByName(fits.select(
                *by, F.col("bracket_lo").alias("lo"), F.col("bracket_hi").alias("hi"), "node", F.col("objective").alias("cost")))
        return rows

    found = zoom_minimum(brackets, by, cost_rows, rounds=3, nodes=13)
    lo, hi = F.log(_by_stat(rules.dispersion_bounds, 0)), F.log(_by_stat(rules.dispersion_bounds, 1))
    tol = F.greatest(F.lit(1e-8), (hi - lo) * 1e-7)
    x = F.col("x")
    return found.select(*by, F.exp(x).alias("dispersion"), x.alias("log_dispersion"), F.col("cost").alias("objective"),
                        ((x - lo <= tol) | (hi - x <= tol)).alias("dispersion_bound_hit"))


# --- dispersion update ----------------------------------------------------------------

def qualified_quotes(quotes: DataFrame, rules: MeanRules) -> DataFrame:
    """Eligible quotes of (statistic, player) curves with enough distinct thresholds across sources."""
    eligible = included(quotes).select(*CURVE, "k", "p")
    enough = curve_sizes(eligible, CURVE).filter(F.col("thresholds") >= rules.minimum_thresholds_per_group).select(*CURVE)
    return eligible.join(enough, CURVE, "left_semi")


def qualify_curves(quotes: DataFrame, fits: DataFrame, rules: MeanRules) -> DataFrame:
    """Residual and leave-one-out verdict of each curve at the first market-only dispersion.

    Failing curves are quarantined where enough others remain.
    """
    at = _bounded(quotes.join(F.broadcast(fits.select("stat", F.col("dispersion").alias("r"))), "stat"), rules)
    fitted = fit_curves(at, CURVE, rules)
    residual = F.col("bound_hit") | (F.col("logit_rmse") > rules.max_current_market_logit_rmse)
    held = ((F.col("holdout_failed_fits") > 0) | F.col("holdout_logit_mae").isNull()
            | (F.col("holdout_logit_mae") > rules.max_current_market_holdout_logit_mae))
    judged = fitted.withColumn("quarantine_reason", F.array_join(F.array_compact(F.array(
        F.when(residual, F.lit("curve_residual_exceeds_limit")), F.when(held, F.lit("threshold_holdout_exceeds_limit")))), "|"))
    left = judged.groupBy("stat").agg(F.count_if(F.col("quarantine_reason") == "").alias("_left"))
    return judged.join(F.broadcast(left), "stat").withColumn("retained", (F.col("quarantine_reason") == "") | (
        F.col("_left") < rules.minimum_calibration_groups)).drop("_left")


def _variant_quality(quotes: DataFrame, shared: DataFrame, rules: MeanRules) -> DataFrame:
    """Pooled residual and leave-one-out error per statistic and variant."""
    keys = ["stat", "variant", "canonical_player_id"]
    at = _bounded(quotes.join(F.broadcast(shared.select("stat", "variant", F.col("dispersion").alias("r"))), "stat"), rules)
    fitted = fit_curves(at, keys, rules)
    n = F.col("quotes")
    return fitted.groupBy("stat", "variant").agg(
        F.count("*").alias("groups"), F.sum(n).alias("quotes"),
        F.sqrt(F.sum(F.pow("logit_rmse", F.lit(2)) * n) / F.sum(n)).alias("logit_rmse"),
        F.max("max_abs_logit_residual").alias("max_abs_logit_residual"),
        F.max("bound_hit").alias("nuisance_mean_bound_hit"), F.sum("holdout_failed_fits").alias("holdout_failed_fits"),
        (F.sum(F.col("holdout_logit_mae") * F.col("holdout_count")) / F.sum(
            F.when(F.col("holdout_logit_mae").isNotNull(), F.col("holdout_count")))).alias("holdout_logit_mae"))


def update_dispersions(quotes: DataFrame, dispersions: DataFrame, rules: MeanRules) -> DataFrame:
    """Dispersion decision per statistic from history and current quotes.

    The table of ``dispersions`` has one row per statistic.
    """
    history = dispersions.withColumn("prior_sd", N.prior_log_sd(
        F.col("historical_log_dispersion_lower"), F.col("historical_log_dispersion_upper"), rules.confidence_level))
    qualified = cut(qualified_quotes(quotes, rules))
    groups = qualified.select(*CURVE).distinct().groupBy("stat").agg(F.count("*").alias("initial_groups"))
    repeated = duplicate_thresholds(quotes)
    status = history.join(groups, "stat", "left").join(repeated, "stat", "left").select(
        "stat", "historical_log_dispersion", "prior_sd", F.coalesce("initial_groups", F.lit(0)).alias("initial_groups"),
        F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"))
    any_repeat = repeated.agg((F.count("*") > 0).alias("any_repeat"), F.lit(1).alias("_k"))
    enough = F.col("initial_groups") >= rules.minimum_calibration_groups
    asked = F.lit(rules.dispersion_mode == "historical_with_current_market_update")
    status = cut(status.withColumn("_k", F.lit(1)).join(any_repeat, "_k").drop("_k").withColumn("updatable", asked & enough & ~F.col("any_repeat") & F.col("prior_sd").isNotNull()))
    updatable = status.filter("updatable")
    usable = qualified.join(F.broadcast(updatable.select("stat")), "stat", "left_semi")

    def variants(*names: str) -> DataFrame:
        prior = F.when(F.col("variant") == "map", F.col("prior_sd"))
        return updatable.withColumn("variant", F.explode(F.array(*[F.lit(n) for n in names]))).select(
            "stat", "variant", F.col("historical_log_dispersion").alias("prior_log"), prior.alias("prior_sd"))

    first = cut(shared_dispersion(usable, variants("market"), rules))
    verdicts = cut(qualify_curves(usable, first, rules))
    kept = cut(usable.join(verdicts.filter("retained").select(*CURVE), CURVE, "left_semi"))
    shared = cut(shared_dispersion(kept, variants("market", "map"), rules))
    quality = _variant_quality(kept, shared, rules)
    fits = shared.join(quality, ["stat", "variant"])
    carried = ["dispersion", "log_dispersion", "objective", "dispersion_bound_hit", "logit_rmse", "nuisance_mean_bound_hit",
               "holdout_logit_mae", "holdout_failed_fits", "groups", "quotes"]
    wide = fits.groupBy("stat").agg(*[
        F.max(F.when(F.col("variant") == v, F.col(c))).alias(f"{v}_{c}") for v in ("market", "map") for c in carried])
    quarantined = verdicts.groupBy("stat").agg(F.count_if(~F.col("retained")).alias("quarantined_groups"))
    sizes = curve_sizes(qualified, CURVE).groupBy("stat").agg(F.sum("quotes").alias("qualified_quotes"))
    joined = dispersions.join(status.select("stat", "initial_groups", "updatable", "prior_sd"), "stat", "left").join(
        wide, "stat", "left").join(quarantined, "stat", "left").join(sizes, "stat", "left")
    return choose_dispersion(joined, rules)


def choose_dispersion(fits: DataFrame, rules: MeanRules) -> DataFrame:
    """Method, final dispersion and fallback reason per statistic."""
    def valid(v):
        return F.coalesce(
            (F.col(f"{v}_logit_rmse") <= rules.max_current_market_logit_rmse) & (F.col(f"{v}_holdout_failed_fits") == 0)
            & (F.col(f"{v}_holdout_logit_mae") <= rules.max_current_market_holdout_logit_mae), F.lit(False))

    fitted = F.col("market_dispersion").isNotNull() & F.col("map_dispersion").isNotNull()
    sound = fitted
    for v in ("market", "map"):
        sound = sound & ~F.col(f"{v}_dispersion_bound_hit") & ~F.col(f"{v}_nuisance_mean_bound_hit")
    sound = F.coalesce(sound, F.lit(False))
    delta = F.abs(F.col("market_log_dispersion") - F.log("historical_dispersion"))
    agrees = F.coalesce(delta <= rules.max_current_market_log_dispersion_delta, F.lit(False))
    warn = F.lit(rules.current_market_conflict_policy == "warning")
    method = (F.when(sound & valid("map") & agrees, "historical_plus_current_market_map")
              .when(sound & valid("market") & warn, "current_market_conflict_override").otherwise("historical_only"))
    reason = (F.when(method == "historical_plus_current_market_map", "")
              .when(method == "current_market_conflict_override", "historical_map_misspecification_current_market_override")
              .when(F.lit(rules.dispersion_mode != "historical_with_current_market_update"), "dispersion_mode_historical_only")
              .when(~F.coalesce("updatable", F.lit(False)), "insufficient_eligible_current_market_groups")
              .when(sound & ~valid("market"), "current_market_validation_failed")
              .when(sound & ~warn, "current_market_historical_conflict")
              .otherwise("current_market_update_optimizer_failed"))
    final = (F.when(method == "historical_plus_current_market_map", F.col("map_dispersion"))
             .when(method == "current_market_conflict_override", F.col("market_dispersion"))
             .otherwise(F.col("historical_dispersion")))
    kept = [c for c in (
        "stat", "distribution_family", "calibration_version", "historical_dispersion", "historical_log_dispersion",
        "historical_dispersion_lower", "historical_dispersion_upper", "historical_log_dispersion_lower",
        "historical_log_dispersion_upper", "status") if c in fits.columns]
    return fits.select(
        *kept, method.alias("method"), method.alias("dispersion_source"), final.alias("final_dispersion"),
        F.lit(rules.market_update_version).alias("market_update_version"),
        F.col("market_dispersion").alias("current_market_only_dispersion"),
        F.col("market_log_dispersion").alias("current_market_only_log_dispersion"),
        F.col("map_dispersion").alias("current_market_map_dispersion"),
        F.col("map_log_dispersion").alias("current_market_map_log_dispersion"),
        F.coalesce("market_groups", "initial_groups", F.lit(0)).alias("current_market_group_count"),
        F.coalesce("market_quotes", "qualified_quotes", F.lit(0)).alias("current_market_quote_count"),
        F.coalesce("quarantined_groups", F.lit(0)).alias("quarantined_groups"),
        F.when(fitted, F.col("prior_sd")).alias("current_market_prior_log_sd"),
        F.when(fitted, F.col("prior_sd") * F.col("prior_sd")).alias("current_market_prior_log_variance"),
        F.col("market_objective").alias("current_market_only_objective"), F.col("map_objective").alias("current_market_map_objective"),
        F.col("market_logit_rmse").alias("current_market_only_logit_rmse"), F.col("map_logit_rmse").alias("current_market_map_logit_rmse"),
        F.col("market_holdout_logit_mae").alias("current_market_only_holdout_logit_mae"),
        F.col("map_holdout_logit_mae").alias("current_market_map_holdout_logit_mae"),
        F.col("map_dispersion_bound_hit").alias("current_market_dispersion_bound_hit"),
        F.col("map_nuisance_mean_bound_hit").alias("current_market_nuisance_mean_bound_hit"),
        F.when(fitted, valid("market")).alias("current_market_only_validation_passed"),
        F.when(fitted, valid("map")).alias("current_market_map_validation_passed"),
        F.when(fitted, delta).alias("current_market_log_dispersion_delta"), reason.alias("fallback_reason"))


# --- source projections ---------------------------------------------------------------

def invert_quotes(quotes: DataFrame, rules: MeanRules) -> DataFrame:
    """Mean implied by each single quote ``stat, k, p, r``; NULL where the bounds do not allow it."""
    at = _bounded(quotes, rules)
    root = at.withColumn("log_mean", invert_log_mean("k", "p", "r", "lo", "hi"))
    low, high = F.log("lo"), F.log("hi")
    tol = F.greatest(F.lit(1e-8), (high - low) * 1e-7)
    return root.withColumns({
        "mean": F.exp("log_mean"), "bound_hit": (F.col("log_mean") - low <= tol) | (high - F.col("log_mean") <= tol),
        "modeled_probability": nb_survival(F.col("k"), F.exp("log_mean"), F.col("r")),
    }).drop("lo", "hi", "log_mean")


def _clean(c: str) -> Column:
    return N.clean_text(F.col(c).cast("string"))


def projection_lineage(quotes: DataFrame) -> DataFrame:
    """The quotes behind every projection, a row each: market, name, threshold, whether it counts and why not."""
    return quotes.select(
        *GROUP, _clean("source_market_id").alias("source_market_id"), _clean("raw_player_name").alias("raw_player_name"),
        F.col("canonical_threshold").cast("int").alias("threshold"), "model_inclusion_status",
        F.nullif("model_exclusion_reason", F.lit("")).alias("model_exclusion_reason"))


def _described(quotes: DataFrame) -> DataFrame:
    """Counts and short lists per projection: reasons and snapshots are bounded by the rules and the run, thresholds by the
    bounds of the mean. What is not bounded, markets and names, is published as rows (``projection_lineage``)."""
    per = quotes.groupBy(*GROUP).agg(
        F.max("canonical_player_name").alias("canonical_player_name"), F.max("canonical_position").alias("canonical_position"),
        F.count("*").alias("quote_count"),
        F.count_if(F.col("model_inclusion_status") == "included").alias("eligible_quote_count"),
        N.pipe_join(F.array_sort(F.collect_set(_clean("snapshot_utc")))).alias("source_snapshot_time"),
        N.pipe_join(F.array_sort(F.collect_set(F.nullif("model_exclusion_reason", F.lit(""))))).alias("excluded_reasons"))
    counted = quotes.filter("model_inclusion_status = 'included'").groupBy(*GROUP, F.col("canonical_threshold").cast("int").alias("k")).agg(
        F.count("*").cast("int").alias("n"))
    used = counted.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("k", "n"))).alias("_k")).select(
        *GROUP, N.pipe_join(F.flatten(F.transform("_k", lambda x: F.array_repeat(x["k"], x["n"])))).alias("thresholds_used"))
    return per.join(used, GROUP, "left").withColumn("thresholds_used", F.coalesce("thresholds_used", F.lit("")))


def _book_means(quotes: DataFrame, rules: MeanRules) -> DataFrame:
    """Single-quote inversion per group, with sensitivity at both dispersion bounds."""
    rows = quotes.groupBy(*GROUP, "r", "r_low", "r_high").agg(
        F.count("*").alias("n"), F.max("k").alias("k"), F.max("p").alias("p"))
    at = _bounded(rows, rules)
    low, high = F.log("lo"), F.log("hi")
    tol = F.greatest(F.lit(1e-8), (high - low) * 1e-7)

    def interior(t):
        return t.isNotNull() & (t - low > tol) & (high - t > tol)

    solved = at.withColumns({
        "t": F.when(F.col("n") == 1, invert_log_mean("k", "p", "r", "lo", "hi")),
        "t_low": invert_log_mean("k", "p", "r_low", "lo", "hi"), "t_high": invert_log_mean("k", "p", "r_high", "lo", "hi")})
    fine = interior(F.col("t_low")) & interior(F.col("t_high"))
    point = interior(F.col("t"))
    off = N.logit(F.col("modeled")) - N.logit(F.col("p"))
    return solved.withColumn("modeled", nb_survival(F.col("k"), F.exp("t"), F.col("r"))).select(
        *GROUP, F.exp("t").alias("mean"), F.lit("single_threshold_bounded_inversion").alias("projection_method"),
        (0.5 * off * off).alias("fit_objective"), F.abs(F.col("modeled") - F.col("p")).alias("fit_error"),
        F.abs(off).alias("logit_rmse"), F.abs(off).alias("max_abs_logit_residual"),
        F.lit(None).cast("double").alias("holdout_logit_mae"), F.lit(0).alias("holdout_failed_fits"),
        F.col("t").isNotNull().alias("optimizer_converged"), (F.col("t").isNotNull() & ~point).alias("mean_bound_hit"),
        F.when(point & fine, F.least(F.exp("t"), F.exp("t_low"), F.exp("t_high"))).alias("sensitivity_low"),
        F.when(point & fine, F.greatest(F.exp("t"), F.exp("t_low"), F.exp("t_high"))).alias("sensitivity_high"),
        (F.when(interior(F.col("t_low")), 0).otherwise(1) + F.when(interior(F.col("t_high")), 0).otherwise(1)).alias("sensitivity_failed_fits"),
        F.when(F.col("n") != 1, "mean_fit_failed:a two-sided group needs exactly one eligible quote")
        .when(F.col("t").isNull(), "mean_fit_failed:probability not attainable within mean bounds").otherwise("").alias("fit_failure"))


def _contract_means(quotes: DataFrame, rules: MeanRules) -> DataFrame:
    """Curve fit per group with leave-one-out error and six sensitivity scenarios."""
    sizes = curve_sizes(quotes, GROUP)
    rows = _bounded(quotes.join(sizes.withColumn("distinct_thresholds", F.col("thresholds") == F.col("quotes")).drop(
        "quotes", "thresholds"), GROUP), rules)
    distinct = rows.filter("distinct_thresholds")
    # Failed groups keep a row without a fit.
    repeated = rows.filter("NOT distinct_thresholds").select(*GROUP).distinct()
    inside = F.lit(True)
    for side in ("bid", "ask"):
        inside = inside & F.coalesce(N.is_finite(F.col(side)) & (F.col(side) > 0) & (F.col(side) < 1), F.lit(False))
    marked = distinct.withColumn("quoted", inside)
    small, large = split_by_size(marked, GROUP, rules.max_curve_quotes_per_task)
    fits = _scenarios_small(small).unionByName(_scenarios_large(large, rules))
    columns = [
        "mean", F.lit("robust_multi_threshold_logit_fit").alias("projection_method"), F.col("objective").alias("fit_objective"),
        F.col("logit_rmse").alias("fit_error"), "logit_rmse", "max_abs_logit_residual", "holdout_logit_mae", "holdout_failed_fits",
        F.col("converged").alias("optimizer_converged"), F.col("bound_hit").alias("mean_bound_hit"),
        F.when(~F.col("bound_hit") & (F.col("scenario_failures") == 0) & F.col("all_quoted"), F.least("mean", "scenario_low")).alias("sensitivity_low"),
        F.when(~F.col("bound_hit") & (F.col("scenario_failures") == 0) & F.col("all_quoted"), F.greatest("mean", "scenario_high")).alias("sensitivity_high"),
        F.col("scenario_failures").alias("sensitivity_failed_fits"), F.lit("").alias("fit_failure")]
    fitted = fits.select(*GROUP, *columns)
    broken = repeated.select(*GROUP, *[
        F.lit(None).cast(t).alias(c) for c, t in fitted.dtypes if c not in (*GROUP, "projection_method", "fit_failure",
                                                                             "optimizer_converged", "mean_bound_hit")],
        F.lit("failed").alias("projection_method"), F.lit(False).alias("optimizer_converged"), F.lit(False).alias("mean_bound_hit"),
        F.lit("mean_fit_failed:curve thresholds must be distinct").alias("fit_failure"))
    return fitted.unionByName(broken)


def _scenarios_small(quotes: DataFrame) -> DataFrame:
    """Point fit, leave-one-out and scenarios as columns of one row: no further shuffle."""
    keys = [*GROUP, "r", "r_low", "r_high", "lo", "hi"]
    arrays = curve_arrays(quotes, keys, extra=("bid", "ask", "quoted"))
    quoted = F.forall("quoteds", lambda q: q == 1.0)
    arrays = arrays.withColumn("all_quoted", quoted).withColumns({
        "bids": F.when(F.col("all_quoted"), F.col("bids")).otherwise(F.col("ps")),
        "asks": F.when(F.col("all_quoted"), F.col("asks")).otherwise(F.col("ps"))})
    names = {f"{p}_{r}": fit_curve("ks", p, r, "lo", "hi") for p in ("ps", "bids", "asks") for r in ("r_low", "r_high")}
    solved = arrays.withColumns({
        "_fit": fit_curve("ks", "ps", "r", "lo", "hi"), "_out": leave_one_out("ks", "ps", "r", "lo", "hi"), **names})
    failures = sum((F.when(F.col(f"{n}.bound_hit"), 1).otherwise(0) for n in list(names)[1:]),
                   F.when(F.col(f"{list(names)[0]}.bound_hit"), 1).otherwise(0))
    return solved.select(
        *GROUP, "_fit.*", F.col("_out.logit_mae").alias("holdout_logit_mae"), F.col("_out.failed").alias("holdout_failed_fits"),
        F.least(*[F.col(f"{n}.mean") for n in names]).alias("scenario_low"),
        F.greatest(*[F.col(f"{n}.mean") for n in names]).alias("scenario_high"),
        failures.alias("scenario_failures"), "all_quoted")


def _scenarios_large(quotes: DataFrame, rules: MeanRules) -> DataFrame:
    if quotes.limit(1).count() == 0:
        return _scenarios_small(quotes.limit(0))
    quoted = quotes.groupBy(*GROUP).agg(F.min("quoted").alias("all_quoted"))
    point = fit_curves(quotes, GROUP, rules).drop("quotes", "holdout_count", "logit_mae")
    marked = quotes.drop("quoted").join(quoted, GROUP)
    cases = marked.withColumn("case", F.explode(F.array(*[
        F.struct(F.lit(f"{p}_{r}").alias("name"), F.when(F.col("all_quoted"), F.col(p)).otherwise(F.col("p")).alias("p"), F.col(r).alias("r"))
        for p in ("p", "bid", "ask") for r in ("r_low", "r_high")])))
    rows = cases.select(*GROUP, F.col("case.name").alias("scenario"), "k", F.col("case.p").alias("p"), F.col("case.r").alias("r"), "lo", "hi")
    scenarios = fit_curves(rows, [*GROUP, "scenario"], rules, holdout=False).groupBy(*GROUP).agg(
        F.min("mean").alias("scenario_low"), F.max("mean").alias("scenario_high"),
        F.count_if("bound_hit").cast("int").alias("scenario_failures"))
    sums = fit_curves(quotes, GROUP, rules, holdout=False).select(*GROUP, "logit_mae")
    return point.join(sums, GROUP).join(scenarios, GROUP).join(quoted, GROUP)


def source_projections(quotes: DataFrame, dispersions: DataFrame, sources: Mapping[str, SourceRules],
                       rules: MeanRules) -> DataFrame:
    """One row per run, season, player, statistic and source: mean, sensitivity, quality and lineage."""
    # One row per statistic.
    r = dispersions.select(
        "stat", F.col("final_dispersion").alias("r"), F.col("historical_dispersion_lower").alias("r_low"),
        F.col("historical_dispersion_upper").alias("r_high"), "dispersion_source", "calibration_version")
    eligible = included(quotes).join(F.broadcast(r), "stat").select(
        *GROUP, "k", "p", F.col("bid_probability").alias("bid"), F.col("ask_probability").alias("ask"), "r", "r_low", "r_high")
    books, contracts = names_of(sources, "book"), names_of(sources, "contract")
    fits = _book_means(eligible.filter(F.col("source").isin(books)), rules).unionByName(
        _contract_means(eligible.filter(F.col("source").isin(contracts)), rules))
    joined = _described(quotes).join(fits, GROUP, "left").join(F.broadcast(r), "stat", "left")
    usable = F.col("optimizer_converged") & ~F.col("mean_bound_hit")
    passed = F.coalesce(usable & F.col("sensitivity_low").isNotNull(), F.lit(False))
    curve = F.col("source").isin(contracts) & passed
    residual = curve & (F.col("logit_rmse") > rules.max_curve_logit_rmse)
    held = curve & (F.col("eligible_quote_count") > 1) & (
        (F.col("holdout_failed_fits") > 0) | F.col("holdout_logit_mae").isNull()
        | (F.col("holdout_logit_mae") > rules.max_curve_holdout_logit_mae))

    def named(text):
        return F.concat(F.col("source"), F.lit(text))

    quarantine = F.array_join(F.array_compact(F.array(
        F.when(residual, named("_curve_residual_exceeds_limit")), F.when(held, named("_curve_holdout_exceeds_limit")))), "|")
    none = F.col("eligible_quote_count") == 0
    reason = (F.when(none, F.coalesce(F.nullif("excluded_reasons", F.lit("")), F.lit("no_eligible_quotes")))
              .when(F.col("quarantine") != "", F.col("quarantine")).when(passed, "")
              .when(F.col("fit_failure") != "", F.col("fit_failure")).when(F.col("mean_bound_hit"), "mean_bound_hit")
              .when(F.col("sensitivity_low").isNull(), "sensitivity_not_identifiable").otherwise("optimizer_nonconvergence"))
    return joined.withColumn("quarantine", quarantine).select(
        *GROUP, "canonical_player_name", F.col("canonical_player_name").alias("display_name"), "canonical_position",
        "source_snapshot_time", "quote_count",
        F.lit("negative_binomial").alias("distribution_family"), F.col("r").alias("fitted_dispersion"), "dispersion_source",
        "calibration_version", F.lit(rules.market_update_version).alias("market_update_version"),
        F.lit(rules.source_estimation_version).alias("source_estimation_version"),
        F.lit("model_sensitivity_not_confidence_interval").alias("sensitivity_label"), "eligible_quote_count",
        "mean", "sensitivity_low", "sensitivity_high",
        F.when(none, "unavailable").when(F.col("fit_failure") != "", "failed").otherwise(F.col("projection_method")).alias("projection_method"),
        "thresholds_used", "fit_objective", "fit_error", "logit_rmse", "max_abs_logit_residual", "holdout_logit_mae",
        "holdout_failed_fits", "optimizer_converged", "mean_bound_hit", "sensitivity_failed_fits",
        F.when(none | (F.col("quarantine") != ""), "excluded").when(passed, "passed").otherwise("failed").alias("quality_status"),
        reason.alias("exclusion_reason"))


def backfill_quotes(quotes: DataFrame, projections: DataFrame) -> DataFrame:
    """Write the fitted mean, modelled probability and residuals to every contributing quote."""
    fit = projections.filter(F.col("mean").isNotNull()).select(
        *GROUP, F.col("mean").alias("source_projection_mean"), F.col("projection_method").alias("source_projection_method"),
        F.col("fitted_dispersion").alias("final_dispersion"), "dispersion_source", "calibration_version", "market_update_version",
        F.col("quality_status").alias("source_projection_quality_status"),
        F.col("exclusion_reason").alias("source_projection_exclusion_reason"))
    written = [c for c in fit.columns if c not in GROUP]
    used = F.col("model_inclusion_status") == "included"
    joined = quotes.join(fit, GROUP, "left")
    joined = joined.withColumns({c: F.when(used, F.col(c)) for c in written})
    modeled = nb_survival(F.col("canonical_threshold").cast("double"), F.col("source_projection_mean"), F.col("final_dispersion"))
    p = F.col("modeling_probability")
    return joined.withColumn("modeled_probability", modeled).withColumns({
        "probability_residual": F.col("modeled_probability") - p,
        "logit_probability_residual": N.logit(F.col("modeled_probability")) - N.logit(p)})


# --- gates ----------------------------------------------------------------------------

def near_even_violations(backfilled: DataFrame, sources: Mapping[str, SourceRules], rules: MeanRules) -> DataFrame:
    """Near-even two-sided quotes whose mean is far from the line's median proxy."""
    low, high = rules.near_even_probability_band
    proxy = F.col("canonical_threshold") - 0.5
    limit = F.greatest(F.lit(rules.max_near_even_mean_shift_absolute), rules.max_near_even_mean_shift_relative * F.col("median_proxy"))
    near = backfilled.filter(
        F.col("source").isin(names_of(sources, "book")) & (F.col("model_inclusion_status") == "included")
        & (F.col("source_projection_quality_status") == "passed") & F.col("modeling_probability").between(low, high))
    return near.withColumn("median_proxy", proxy).withColumns({
        "absolute_shift": F.abs(F.col("source_projection_mean") - F.col("median_proxy")), "maximum_shift": limit,
    }).withColumn("violation", F.col("absolute_shift") > F.col("maximum_shift"))


def rising_survival(backfilled: DataFrame) -> DataFrame:
    """Neighbouring thresholds of a projection whose modelled probability rises.

    Survival at one mean and dispersion depends on the threshold alone, so each
    projection is first reduced to its distinct thresholds.
    """
    points = backfilled.filter(F.col("modeled_probability").isNotNull()).groupBy(*GROUP, "canonical_threshold").agg(
        F.min("modeled_probability").alias("low"), F.max("modeled_probability").alias("high"))
    before = F.lag("low").over(Window.partitionBy(*GROUP).orderBy("canonical_threshold"))
    return points.withColumn("previous", before).filter(F.col("high") - F.col("previous") > 1e-12)


def model_gate(projections: DataFrame, backfilled: DataFrame, dispersions: DataFrame, sources: Mapping[str, SourceRules],
               rules: MeanRules) -> DataFrame:
    """Optimizers, residuals, bounds, plausibility, lineage, monotonicity and final dispersions."""
    book = F.col("source").isin(names_of(sources, "book"))
    passed = F.col("quality_status") == "passed"
    attempted = F.col("optimizer_converged").isNotNull()
    inside = (F.col("mean") > _by_stat(rules.mean_bounds, 0)) & (F.col("mean") < _by_stat(rules.mean_bounds, 1)) & (
        F.col("sensitivity_low") <= F.col("mean")) & (F.col("mean") <= F.col("sensitivity_high"))
    counted = projections.agg(
        F.count_if(passed).alias("passed"),
        F.count_if(attempted & (~F.col("optimizer_converged") | F.col("mean_bound_hit"))).alias("unsolved"),
        F.count_if(attempted & F.col("sensitivity_low").isNull()).alias("no_bounds"),
        F.max(F.when(book, F.col("fit_error"))).alias("book_residual"),
        F.max(F.when(passed & ~book, F.col("logit_rmse"))).alias("curve_residual"),
        F.max(F.when(passed & ~book, F.col("holdout_logit_mae"))).alias("curve_holdout"),
        F.count_if(~book & (F.col("quality_status") == "excluded") & F.col("mean").isNotNull()).alias("quarantined"),
        F.count_if(passed & ~F.coalesce(inside, F.lit(False))).alias("outside"))
    used = F.col("model_inclusion_status") == "included"
    lineage = backfilled.agg(
        F.count_if(~used & F.col("modeled_probability").isNotNull()).alias("excluded_contributed"),
        F.count_if(used & F.col("modeled_probability").isNull()).alias("included_missing"),
        F.count_if((F.col("inclusion_status") == "included") & F.col("model_exclusion_reason").isin(
            "invalid_model_threshold", "invalid_model_probability")).alias("broken_contract"))
    near = near_even_violations(backfilled, sources, rules).agg(F.count("*").alias("evaluated"), F.count_if("violation").alias("violations"))
    rising = rising_survival(backfilled).agg(F.count("*").alias("rising"))
    methods = ("historical_only", "historical_plus_current_market_map", "current_market_conflict_override")
    final = dispersions.agg(F.count_if(~F.coalesce((F.col("final_dispersion") > 0) & N.is_finite(
        F.col("final_dispersion")) & F.col("dispersion_source").isin(*methods), F.lit(False))).alias("bad"))
    repeated = duplicate_thresholds(backfilled).agg(F.coalesce(F.sum("duplicate_rows"), F.lit(0)).alias("rows"))

    def at_most(c, limit):
        return F.coalesce(F.col(c), F.lit(0.0)) <= limit

    return all_checks(
        check_table(repeated, [Check("model.current_market_thresholds_unique_within_source", F.col("rows") == 0,
                                     "a source quotes each threshold of a curve once", details={"duplicate_rows": F.col("rows")})]),
        grain_check(projections, GROUP, "model.source_projection_keys", "projection grain is unique"),
        check_table(counted, [
            Check("model.at_least_one_projection", F.col("passed") > 0, "a projection is eligible", details={"eligible_rows": F.col("passed")}),
            Check("model.mean_optimizers", F.col("unsolved") == 0, "every attempted mean is solved inside its bounds", details={"rows": F.col("unsolved")}),
            Check("model.sensitivity_bounds", F.col("no_bounds") == 0, "every fitted mean has sensitivity bounds", details={"rows": F.col("no_bounds")}),
            Check("model.book_back_substitution", at_most("book_residual", rules.max_sportsbook_probability_residual), "two-sided residuals are within tolerance"),
            Check("model.curve_source_residuals", at_most("curve_residual", rules.max_curve_logit_rmse), "passed curves have small residuals"),
            Check("model.curve_source_holdout", at_most("curve_holdout", rules.max_curve_holdout_logit_mae), "passed curves predict left-out thresholds"),
            Check("model.curves_quarantined", F.col("quarantined") == 0, "curves beyond limits are kept out of the consensus", "warning", {"curves": F.col("quarantined")}),
            Check("model.mean_domains", F.col("outside") == 0, "means and bounds are ordered and inside their domain", details={"rows": F.col("outside")})]),
        check_table(lineage, [
            Check("model.pricing_included_quote_contract", F.col("broken_contract") == 0, "priced quotes keep valid thresholds and probabilities", details={"rows": F.col("broken_contract")}),
            Check("model.quote_inclusion_lineage", (F.col("excluded_contributed") == 0) & (F.col("included_missing") == 0),
                  "exactly the included quotes contribute", details={"included_missing": F.col("included_missing"), "excluded_contributed": F.col("excluded_contributed")})]),
        check_table(near, [Check("model.near_even_market_mean_plausibility", F.col("violations") == 0, "near-even lines imply means near their median",
                                 details={"evaluated_quotes": F.col("evaluated"), "violations": F.col("violations")})]),
        check_table(rising, [Check("model.fitted_survival_monotonicity", F.col("rising") == 0, "modelled survival never rises with the threshold", details={"thresholds": F.col("rising")})]),
        check_table(final, [Check("model.final_dispersions", F.col("bad") == 0, "every statistic has a positive final dispersion and a method", details={"statistics": F.col("bad")})]))
