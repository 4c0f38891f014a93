"""Historical dispersion: likelihood fits, hierarchical bootstrap, holdout evaluation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from curvelake.functions.numeric import half_life_weight, is_finite, pipe_ints, pipe_join
from curvelake.functions.special import nb_logpmf, nb_quantile, nb_survival, np_nb_logpmf, poisson_logpmf
from curvelake.operators.checks import Check, all_checks, check_table, grain_check
from curvelake.operators.history import ENTITY
from curvelake.operators.minimize import refine_on_grid, zoom_minimum
from curvelake.operators.ranks import row_ranks
from curvelake.rules import CalibrationRules, HistoryRules
from curvelake.session import cut, spread

# The hash field of the bootstrap draws (largest prime below 2**28)
# and the cumulative probabilities of a unit Poisson count.
HASH_PRIME = 268435399
UNIT_POISSON = tuple(sum(math.exp(-1.0) / math.factorial(j) for j in range(i + 1)) for i in range(12))
# Points at which the replicates' costs are summed, points that place a minimum between them, and
# points that locate the replicates over the whole bounds.
BOOTSTRAP_NODES, FINE_POINTS, COARSE_POINTS = 15, 129, 61
# What ``prediction_contract``, ``window_rows`` and ``cohort_gate`` read of the calibrated predictions, beside the seasons of the lags.
PREDICTION_READS = (
    "target_season", ENTITY, "stat", "training_eligible", "realized_total", "target_games", "baseline_mean", "baseline_mean_raw", "feature_seasons",
    "max_feature_season", "baseline_bias_method", "baseline_bias_intercept", "baseline_bias_exponent", "baseline_bias_recency_half_life_seasons",
    "baseline_bias_optimizer_converged", "baseline_bias_bound_hit", "baseline_bias_max_observation_season")
# Rows whose counts for all draws of their season are held at once.
BOOTSTRAP_ROWS = 512


def window_rows(predictions: DataFrame, history: HistoryRules) -> DataFrame:
    """Training-eligible rows of the calibration window, with the reason a row cannot be used."""
    y, mu = F.col("realized_total"), F.col("baseline_mean")
    reason = (F.when(y < 0, "negative_outcome")
              .when(F.abs(y - F.rint(y)) > 1e-9, "noninteger_outcome")
              .when(mu.isNull() | ~is_finite(mu) | (mu < 0), "invalid_baseline")
              .when((mu == 0) & (y > 0), "impossible_zero_baseline")
              .when(mu == 0, "zero_baseline"))
    in_window = F.col("target_season").between(history.calibration_start_season, history.latest_completed_season)
    return predictions.filter(in_window & F.col("training_eligible")).select(
        "*", reason.alias("unusable"), (F.col("target_season") >= history.holdout_start).alias("is_holdout"))


def usable_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("unusable").isNull())


def training_rows(rows: DataFrame, history: HistoryRules) -> DataFrame:
    """Usable pre-holdout rows: outcome ``y``, fixed mean ``mu``, recency weight ``w``."""
    age = F.lit(history.holdout_start - 1) - F.col("target_season")
    return spread(usable_rows(rows).filter(~F.col("is_holdout")), ENTITY).select(
        "stat", F.col("target_season").alias("season"), ENTITY, F.rint("realized_total").alias("y"),
        F.col("baseline_mean").alias("mu"),
        half_life_weight(age, history.recency_half_life_seasons).alias("w"))


def _bounds(rules: CalibrationRules, column: str = "stat") -> tuple[Column, Column]:
    """log bounds by statistic, as expressions over a small literal map."""
    def lookup(side):
        return F.create_map(*[x for s, b in rules.dispersion_bounds.items() for x in (F.lit(s), F.lit(math.log(b[side])))])
    return F.try_element_at(lookup(0), F.col(column)), F.try_element_at(lookup(1), F.col(column))


def _costs(rows: pd.DataFrame, r: np.ndarray) -> np.ndarray:
    """Weighted cost of every row at every dispersion; as in a sum of SQL, one that is unknown adds nothing."""
    y, mu, w = (rows[c].to_numpy(float)[:, None] for c in ("y", "mu", "w"))
    return np.where(np.isnan(y + mu + w), 0.0, -w * np_nb_logpmf(y, mu, r))


def fit_dispersion(observations: DataFrame, by: Sequence[str], rules: CalibrationRules) -> DataFrame:
    """Weighted likelihood fit of one dispersion per key, with the means held fixed.

    ``observations`` (``by, y, mu, w``) should be materialised: it is read once per
    zoom round. ``by`` must contain ``stat`` and take few values.
    """
    lo, hi = _bounds(rules)
    totals = observations.groupBy(*by).agg(
        F.count("*").alias("player_seasons"), F.avg("w").alias("mean_weight"),
        F.min("season").alias("first_season"), F.max("season").alias("last_season"))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in observations.select(*by).schema)
    arrow = [to_arrow_type(f.dataType) for f in observations.select(*by).schema]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each task's sums over its rows, per key and node."""
        found: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, group in batch.to_pandas().groupby([*by, "lo", "hi", "nodes"]):
                low, high, nodes = key[-3:]
                grid = np.exp(low + (high - low) * np.arange(nodes) / (nodes - 1))
                found[key] = found.get(key, 0.0) + _costs(group, grid).sum(axis=0)
        for (*own, low, high, nodes), costs in found.items():
            yield pa.RecordBatch.from_arrays([
                *[pa.array([v] * nodes, t) for v, t in zip(own, arrow, strict=True)], pa.array([low] * nodes, pa.float64()), pa.array([high] * nodes, pa.float64()),
                pa.array(range(nodes), pa.int32()), pa.array(costs)], names=[*by, "lo", "hi", "node", "cost"])

    def cost_rows(state: DataFrame) -> DataFrame:
        joined = observations.join(F.broadcast(state), list(by)).select(*by, "lo", "hi", F.size("grid").alias("nodes"), "y", "mu", "w")
        return joined.mapInArrow(sums, f"{kinds}, lo double, hi double, node int, cost double")

    found = zoom_minimum(totals.select(*by, lo.alias("lo"), hi.alias("hi")), by, cost_rows)
    span = hi - lo
    tolerance = F.greatest(F.lit(1e-5), span * 1e-5)
    x = F.col("x")
    return found.join(totals, list(by)).select(
        *by, F.exp(x).alias("dispersion"), x.alias("log_dispersion"),
        (F.col("cost") / F.col("mean_weight")).alias("objective_nll"),
        (F.col("cost") / F.col("mean_weight") / F.col("player_seasons")).alias("nll_per_weight"),
        F.col("player_seasons"), (F.col("curvature") / F.col("mean_weight")).alias("curvature"),
        is_finite(F.col("cost")).alias("converged"),
        ((x - lo <= tolerance) | (hi - x <= tolerance)).alias("bound_hit"))


def with_windows(training: DataFrame, history: HistoryRules, rules: CalibrationRules) -> DataFrame:
    """Repeat training rows under every sensitivity window that contains them, and under ``full``."""
    starts = [max(history.calibration_start_season, s) for s in rules.sensitivity_start_seasons]
    windows = [F.lit("full")] + [
        F.when(F.col("season") >= start, F.lit(str(configured)))
        for configured, start in zip(rules.sensitivity_start_seasons, starts)]
    return training.withColumn("window", F.explode(F.array_compact(F.array(*windows))))


def window_sensitivity(fits: DataFrame, history: HistoryRules, rules: CalibrationRules) -> DataFrame:
    """Distance of every sensitivity window's log-dispersion from the full fit."""
    # Bounded by the rules: statistics times windows.
    full = fits.filter("window = 'full'").select("stat", F.col("log_dispersion").alias("full_log_dispersion"))
    expected = full.select("stat", "full_log_dispersion", F.explode(F.array(*[
        F.struct(F.lit(str(s)).alias("window"),
                 F.lit(max(history.calibration_start_season, s)).alias("effective_start_season"))
        for s in rules.sensitivity_start_seasons])).alias("w")).select("stat", "full_log_dispersion", "w.*")
    short = F.coalesce("player_seasons", F.lit(0)) < rules.minimum_sensitivity_player_seasons_per_stat
    good = F.col("converged") & ~F.col("bound_hit")
    return expected.join(fits.filter("window <> 'full'"), ["stat", "window"], "left").select(
        "stat", F.col("window").cast("int").alias("configured_start_season"), "effective_start_season",
        F.coalesce("player_seasons", F.lit(0)).alias("player_seasons"),
        F.when(short, "insufficient_data").when(good, "passed").otherwise("failed").alias("status"),
        F.when(~short, F.col("dispersion")).alias("dispersion"),
        F.when(~short, F.abs(F.col("log_dispersion") - F.col("full_log_dispersion"))).alias("log_dispersion_delta"))


# --- bootstrap ------------------------------------------------------------------------

def _hash_parts(text: Column) -> tuple[Column, Column]:
    digest = F.md5(text)

    def part(start):
        return F.conv(F.substring(digest, start, 7), 16, 10).cast("long") % HASH_PRIME
    return part(1), part(8)


def season_draws(training: DataFrame, rules: CalibrationRules) -> DataFrame:
    """Seasons drawn with replacement: one row per (stat, replicate, slot). Bounded by the rules."""
    seasons = training.groupBy("stat").agg(F.array_sort(F.collect_set("season")).alias("seasons"))
    slots = seasons.select("*", F.explode(F.sequence(F.lit(0), F.lit(rules.bootstrap_samples - 1))).alias("replicate")).select(
        "*", F.explode(F.sequence(F.lit(0), F.size("seasons") - 1)).alias("slot"))
    draw = _hash_parts(F.concat_ws("|", F.lit(str(rules.random_seed)), "stat", F.col("replicate").cast("string"),
                                   F.col("slot").cast("string")))[0]
    return slots.select("stat", "replicate", "slot",
                        F.get("seasons", (draw % F.size("seasons")).cast("int")).alias("season"),
                        (F.col("replicate") * F.size("seasons") + F.col("slot") + 1).cast("long").alias("ticket"))


def _chebyshev(n: int) -> list[float]:
    """Chebyshev-Lobatto points on [-1, 1], in rising order."""
    return [-math.cos(math.pi * j / (n - 1)) for j in range(n)]


def _interpolation(n: int, points: int) -> list[list[float]]:
    """Weights that take values at ``n`` Chebyshev points to ``points`` even ones (barycentric form)."""
    x, rows = _chebyshev(n), []
    side = [(-1.0) ** j * (0.5 if j in (0, n - 1) else 1.0) for j in range(n)]
    for i in range(points):
        at = -1.0 + 2.0 * i / (points - 1)
        same = [j for j in range(n) if abs(at - x[j]) < 1e-12]
        parts = [1.0 if j in same else 0.0 for j in range(n)] if same else [side[j] / (at - x[j]) for j in range(n)]
        rows.append([v / sum(parts) for v in parts])
    return rows


def _season_costs(training: DataFrame, rules: CalibrationRules) -> DataFrame:
    """``stat, season, node, cost``: each task's sums over its rows at even points of the whole bounds."""
    grids = {s: np.exp(np.linspace(math.log(lo), math.log(hi), COARSE_POINTS)) for s, (lo, hi) in rules.dispersion_bounds.items()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for (stat, season), group in batch.to_pandas().groupby(["stat", "season"]):
                if stat in grids:
                    found[stat, season] = found.get((stat, season), 0.0) + _costs(group, grids[stat]).sum(axis=0)
        for (stat, season), costs in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([stat] * COARSE_POINTS), pa.array([int(season)] * COARSE_POINTS, pa.int64()), pa.array(range(COARSE_POINTS), pa.int32()), pa.array(costs)],
                names=["stat", "season", "node", "cost"])

    parts = training.select("stat", F.col("season").cast("long").alias("season"), "y", "mu", "w").mapInArrow(
        sums, "stat string, season long, node int, cost double")
    return parts.groupBy("stat", "season", "node").agg(F.sum("cost").alias("cost"))


def _locate(training: DataFrame, draws: DataFrame, fits: DataFrame, rules: CalibrationRules) -> DataFrame:
    """``stat, first, last``: where the replicates' minima lie, from sums per season over the whole bounds.

    Drawing players moves a replicate by a few standard errors of the full fit, which are added at both ends.
    """
    lo, hi = _bounds(rules)
    seasons = _season_costs(training, rules)
    summed = draws.join(seasons, ["stat", "season"]).groupBy("stat", "replicate", "node").agg(F.sum("cost").alias("cost"))
    best = summed.groupBy("stat", "replicate").agg(F.min_by("node", F.struct("cost", "node")).alias("node"))
    step = (hi - lo) / (COARSE_POINTS - 1)
    spread_ = best.groupBy("stat").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    pad = step + 6.0 / F.sqrt("curvature")
    return spread_.join(fits.filter("window = 'full'").filter(F.col("curvature") > 0).select("stat", "curvature"), "stat").select(
        "stat", F.greatest(lo, lo + step * F.col("low") - pad).alias("first"), F.least(hi, lo + step * F.col("high") + pad).alias("last"))


def _unit_poisson(h1: np.ndarray, h2: np.ndarray, tickets: np.ndarray) -> np.ndarray:
    """Counts of every row (hashes ``h1, h2``) under every ticket."""
    prime = np.uint64(HASH_PRIME)
    mixed = h1[:, None] + tickets * h2[:, None]
    mixed -= mixed // prime * prime
    mixed = mixed * mixed + tickets
    mixed -= mixed // prime * prime
    u, times = mixed.astype(np.int32), np.zeros(mixed.shape, np.int8)
    for c in UNIT_POISSON:
        # The least hash whose share reaches c; a share is a quotient of doubles.
        least = int(c * HASH_PRIME) - 1
        while least / float(HASH_PRIME) < c:
            least += 1
        times += u >= least
    return times


def _drawn_sums(training: DataFrame, draws: Mapping[tuple, tuple[np.ndarray, np.ndarray]], brackets: Mapping[str, tuple[float, float]], replicates: int) -> DataFrame:
    """``stat, replicate, drawn_rows, c0, c1 ...``: each task's sums over its rows of the costs at a bracket's points, a row as often as drawn.

    The counts of some rows under all tickets of their season are a matrix, and its product with the rows' costs their share of the sums.
    """
    names = ["stat", "replicate", "drawn_rows", *[f"c{i}" for i in range(BOOTSTRAP_NODES)]]
    points = np.array(_chebyshev(BOOTSTRAP_NODES))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            rows = batch.to_pandas()
            for (stat, season), group in rows.groupby(["stat", "season"]):
                if stat not in brackets or (stat, season) not in draws:
                    continue
                (first, last), (tickets, owner) = brackets[stat], draws[stat, season]
                r = np.exp((last + first) / 2.0 + (last - first) / 2.0 * points)
                values = np.hstack([_costs(group, r), np.ones((len(group), 1))])  # the last column counts
                h1, h2 = (group[c].to_numpy(np.uint64) for c in ("h1", "h2"))
                mine = found.setdefault(stat, np.zeros((replicates, BOOTSTRAP_NODES + 1)))
                for i in range(0, len(group), BOOTSTRAP_ROWS):
                    part = slice(i, i + BOOTSTRAP_ROWS)
                    times = _unit_poisson(h1[part], h2[part], tickets).astype(float)
                    np.add.at(mine, owner, times.T @ values[part])
        for stat, mine in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([stat] * replicates), pa.array(range(replicates), pa.int32()), pa.array(np.rint(mine[:, -1]).astype(np.int64)),
                *[pa.array(mine[:, i]) for i in range(BOOTSTRAP_NODES)]], names=names)

    doubles = "".join(f", {c} double" for c in names[3:])
    return training.select("stat", "season", "y", "mu", "w", "h1", "h2").mapInArrow(sums, f"stat string, replicate int, drawn_rows long{doubles}")


def bootstrap_dispersion(training: DataFrame, fits: DataFrame, rules: CalibrationRules) -> DataFrame:
    """Refit every replicate of a hierarchical bootstrap.

    Seasons are drawn with replacement; inside each drawn season every player
    enters a unit-Poisson number of times, the large-sample form of drawing as
    many players as there are, with replacement (the fit ignores the total
    weight). The count is a hash of row and draw, so a replicate needs no shuffle
    of the observations, and a task returns one sum per replicate and point. A replicate's cost is summed at Chebyshev points of a
    bracket that all replicates of the statistic share; the polynomial through
    them is minimised. A bracket that turns out too narrow for a replicate is
    widened, up to the whole bounds, so no replicate is lost.
    """
    lo, hi = _bounds(rules)
    draws = cut(season_draws(training, rules))
    h1, h2 = _hash_parts(F.concat_ws("|", F.lit(str(rules.random_seed)), "stat", F.col("season").cast("string"), ENTITY))
    rows = training.withColumns({"h1": h1, "h2": h2})
    # Bounded by the rules: a ticket per statistic, replicate and season.
    tickets: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for (stat, season), mine in draws.toPandas().groupby(["stat", "season"]):
        tickets[stat, season] = mine["ticket"].to_numpy(np.uint64), mine["replicate"].to_numpy(np.int64)
    weights = F.array(*[F.array(*[F.lit(v) for v in row]) for row in _interpolation(BOOTSTRAP_NODES, FINE_POINTS)])
    tolerance = F.greatest(F.lit(1e-5), (hi - lo) * 1e-5)

    def refit(brackets: DataFrame) -> DataFrame:
        # Bounded by the rules: one bracket per statistic.
        bounds = {b["stat"]: (b["first"], b["last"]) for b in brackets.collect()}
        parts = _drawn_sums(rows, tickets, bounds, rules.bootstrap_samples)
        summed = parts.groupBy("stat", "replicate").agg(F.sum("drawn_rows").alias("drawn_rows"), *[
            F.sum(f"c{i}").alias(f"c{i}") for i in range(BOOTSTRAP_NODES)]).filter("drawn_rows > 0").join(F.broadcast(brackets), "stat")
        sums = F.array(*[f"c{i}" for i in range(BOOTSTRAP_NODES)])
        fine = cut(summed.select("stat", "replicate", "first", "last", "drawn_rows", sums.alias("sums"))).withColumn(
            "costs", F.transform(weights, lambda row: F.aggregate(F.zip_with(row, "sums", lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)))
        found = refine_on_grid(fine, F.col("first"), (F.col("last") - F.col("first")) / (FINE_POINTS - 1))
        short = (((F.col("best") == 0) & (F.col("first") > lo + tolerance))
                 | ((F.col("best") == FINE_POINTS - 1) & (F.col("last") < hi - tolerance)))
        return cut(found.withColumn("short", short))

    brackets = cut(_locate(training, draws, fits, rules))
    found = refit(brackets)
    done = found.filter("false")
    while True:
        narrow = found.filter("short").select("stat").distinct()
        if narrow.isEmpty():
            break
        done = done.union(found.join(F.broadcast(narrow), "stat", "left_anti").select(done.columns))
        width = F.col("last") - F.col("first")
        brackets = cut(brackets.join(F.broadcast(narrow), "stat", "left_semi").select(
            "stat", F.greatest(lo, F.col("first") - width).alias("first"), F.least(hi, F.col("last") + width).alias("last")))
        found = refit(brackets)
    found = done.union(found.select(done.columns))
    x, best = F.col("x"), F.col("best")
    bound = (x - lo <= tolerance) | (hi - x <= tolerance)
    return found.select(
        "stat", "replicate", "drawn_rows", x.alias("log_dispersion"),
        ((best > 0) & (best < FINE_POINTS - 1) & (F.col("curvature") > 0)).alias("converged"), bound.alias("bound_hit"))


def bootstrap_summary(replicates: DataFrame, rules: CalibrationRules) -> DataFrame:
    """Success rate and interpolated quantile bounds of the log-dispersion per statistic."""
    tail = (1.0 - rules.bootstrap_confidence_level) / 2.0
    ok = F.col("converged") & ~F.col("bound_hit")
    # At most bootstrap_samples values per statistic, so an exact percentile is small.
    bounds = F.percentile(F.when(ok, F.col("log_dispersion")), F.array(F.lit(tail), F.lit(1.0 - tail)))
    asked = rules.bootstrap_samples
    return replicates.groupBy("stat").agg(
        F.lit(asked).alias("samples_requested"), F.count_if(ok).alias("successful_samples"),
        F.count_if(F.col("bound_hit")).alias("bound_hit_samples"),
        F.count_if(~F.col("converged") & ~F.col("bound_hit")).alias("failed_samples"),
        (F.count_if(ok) / asked).alias("success_rate"), bounds.alias("_b"),
    ).select("*", F.get("_b", F.lit(0)).alias("log_dispersion_lower"), F.get("_b", F.lit(1)).alias("log_dispersion_upper")).select(
        "*", F.exp("log_dispersion_lower").alias("dispersion_lower"), F.exp("log_dispersion_upper").alias("dispersion_upper"),
        ((F.col("success_rate") >= rules.minimum_bootstrap_success_rate)
         & F.col("log_dispersion_lower").isNotNull()).alias("passed")).drop("_b")


# --- holdout --------------------------------------------------------------------------

def holdout_rows(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Usable holdout rows with their statistic's dispersion, log-likelihoods and errors."""
    r = fits.select("stat", F.col("dispersion").alias("r"))
    y, mu = F.rint("realized_total"), F.col("baseline_mean")
    return spread(usable_rows(rows).filter("is_holdout"), ENTITY).join(F.broadcast(r), "stat").select(
        "stat", "target_season", ENTITY, "position", "target_games", y.alias("y"), mu.alias("mu"),
        F.col("baseline_mean_raw").alias("raw_mu"), "r",
        nb_logpmf(y, mu, F.col("r")).alias("log_nb"), poisson_logpmf(y, mu).alias("log_poisson"))


def _group_metrics() -> list[Column]:
    error = F.col("y") - F.col("mu")
    return [F.count("*").alias("count"), F.avg("mu").alias("mean_baseline"), F.avg("y").alias("mean_realized"),
            F.avg(error).alias("bias"), F.avg(F.abs(error)).alias("mean_absolute_error"),
            (-F.avg("log_nb")).alias("negative_log_likelihood_per_player_season")]


def holdout_summary(holdout: DataFrame) -> DataFrame:
    error, raw_error = F.col("y") - F.col("mu"), F.col("y") - F.col("raw_mu")
    return holdout.groupBy("stat").agg(
        F.count("*").alias("count"), (-F.sum("log_nb")).alias("negative_log_likelihood"),
        (-F.avg("log_nb")).alias("negative_log_likelihood_per_player_season"),
        (-F.avg("log_poisson")).alias("poisson_negative_log_likelihood_per_player_season"),
        F.avg(F.col("log_poisson") - F.col("log_nb")).alias("nll_regret_vs_poisson_per_player_season"),
        F.avg(error).alias("bias"), F.avg(F.abs(error)).alias("mean_absolute_error"),
        (F.sum(error) / F.sum("mu")).alias("relative_bias"),
        F.avg(raw_error).alias("raw_baseline_bias"), F.avg(F.abs(raw_error)).alias("raw_baseline_mean_absolute_error"),
        (F.sum(raw_error) / F.sum("raw_mu")).alias("raw_baseline_relative_bias"))


def mean_bins(holdout: DataFrame, rules: CalibrationRules) -> DataFrame:
    """Equal-count bins of the baseline, whose edges follow interpolated quantiles of the row rank."""
    ranked = row_ranks(holdout, ["stat"], ["mu", "target_season", ENTITY])
    q = F.least(F.lit(rules.mean_calibration_bins), F.col("group_rows"))
    steps, width = (F.col("rank") - 1) * q, F.col("group_rows") - 1
    # Exact integer ceiling of (rank - 1) * q / (n - 1).
    bin_ = F.coalesce(F.greatest(F.lit(1), F.try_divide(steps + width - 1 - F.pmod(steps + width - 1, width), width)), F.lit(1))
    return ranked.withColumn("bin", bin_.cast("int")).groupBy("stat", "bin").agg(*_group_metrics())


def availability_band(games: Column) -> Column:
    return F.when(games <= 8, "0-8").when(games <= 13, "9-13").otherwise("14+")


def cohort_metrics(holdout: DataFrame) -> DataFrame:
    """Metrics by position and by availability, from one pass with grouping sets."""
    rows = holdout.select("*", F.coalesce("position", F.lit("missing")).alias("position_group"),
                          availability_band(F.col("target_games")).alias("band"))
    grouped = rows.groupingSets(
        [[F.col("stat"), F.col("position_group")], [F.col("stat"), F.col("band")]],
        "stat", "position_group", "band").agg(*_group_metrics())
    return grouped.select(
        "stat", F.when(F.col("band").isNull(), "position").otherwise("availability").alias("cohort_kind"),
        F.coalesce("band", "position_group").alias("cohort"),
        "count", "mean_baseline", "mean_realized", "bias", "mean_absolute_error",
        "negative_log_likelihood_per_player_season")


def brier_events(holdout: DataFrame, rules: CalibrationRules) -> DataFrame:
    """Calibration of the events ``X > predictive quantile`` at fixed levels."""
    levels = F.array(*[F.lit(float(v)) for v in rules.brier_event_cdf_levels])
    events = holdout.select("stat", "y", "mu", "r", F.explode(levels).alias("cdf_level")).withColumn(
        "k", nb_quantile("cdf_level", "mu", "r") + 1.0).withColumn("predicted", nb_survival("k", "mu", "r"))
    hit = F.when(F.col("y") >= F.col("k"), 1.0).otherwise(0.0)
    return events.groupBy("stat", "cdf_level").agg(
        F.count("*").alias("rows"), F.avg(F.pow(F.col("predicted") - hit, 2)).alias("brier_score"),
        F.avg("predicted").alias("mean_predicted_probability"), F.avg(hit).alias("empirical_event_rate"),
        F.abs(F.avg("predicted") - F.avg(hit)).alias("calibration_gap"))


def interval_coverage(holdout: DataFrame, rules: CalibrationRules) -> DataFrame:
    """Empirical against model-implied coverage of equal-tailed predictive intervals."""
    levels = F.array(*[F.lit(float(v)) for v in rules.interval_levels])
    tail = (1.0 - F.col("nominal_level")) / 2.0
    bounds = holdout.select("stat", "y", "mu", "r", F.explode(levels).alias("nominal_level")).withColumns({
        "low": nb_quantile(tail, F.col("mu"), F.col("r")), "high": nb_quantile(1.0 - tail, F.col("mu"), F.col("r"))})
    mass = nb_survival(F.col("low"), F.col("mu"), F.col("r")) - nb_survival(F.col("high") + 1.0, F.col("mu"), F.col("r"))
    inside = F.when(F.col("y").between(F.col("low"), F.col("high")), 1.0).otherwise(0.0)
    return bounds.withColumn("mass", mass).groupBy("stat", "nominal_level").agg(
        F.avg("mass").alias("mean_model_implied_coverage"), F.avg(inside).alias("empirical_coverage"),
        F.abs(F.avg(inside) - F.avg("mass")).alias("absolute_error"))


# --- gates and the published table ----------------------------------------------------

def prediction_contract(predictions: DataFrame, history: HistoryRules) -> DataFrame:
    """Input gate: grain, lineage of features against their declared maximum, calibrated rows."""
    lags = [F.col(c).cast("int") for c in predictions.columns if c.startswith("lag_") and c.endswith("_season")]
    parsed = pipe_ints(F.col("feature_seasons"))
    features = F.array_compact(F.concat(
        parsed, F.array(*lags, F.col("baseline_bias_max_observation_season").cast("int"))))
    latest, declared = F.array_max(features), F.col("max_feature_season").cast("int")
    fitted = F.col("baseline_bias_method") == history.power_fit.method
    positive = [is_finite(F.col(c)) & (F.col(c) > 0) for c in
                ("baseline_bias_exponent", "baseline_bias_recency_half_life_seasons")]
    sound = (is_finite(F.col("baseline_mean_raw")) & (F.col("baseline_mean_raw") >= 0)
             & is_finite(F.col("baseline_bias_intercept")) & positive[0] & positive[1]
             & F.col("baseline_bias_optimizer_converged") & ~F.col("baseline_bias_bound_hit")
             & F.col("baseline_bias_max_observation_season").isNotNull())
    counted = predictions.agg(
        F.count_if(~F.col("stat").isin(*history.stats)).alias("unknown"),
        F.count_if(F.exists(parsed, lambda x: x.isNull())).alias("unparsed"),
        F.count_if(latest >= F.col("target_season")).alias("leaks"),
        F.count_if(~latest.eqNullSafe(declared)).alias("mismatches"),
        F.count_if(fitted & ~F.coalesce(sound, F.lit(False))).alias("unsound"),
        F.count_if(F.col("target_season").isNull() | F.col("realized_total").isNull() | F.col("target_games").isNull())
        .alias("untyped"))

    def zero(name, column, message):
        return Check(f"historical_calibration.{name}", F.col(column) == 0, message, details={"rows": F.col(column)})

    return all_checks(
        grain_check(predictions, ["target_season", ENTITY, "stat"], "historical_calibration.input_keys",
                    "prediction keys are unique"),
        check_table(counted, [
            zero("input_types", "untyped", "seasons, outcomes and games are present"),
            zero("supported_stats", "unknown", "statistics are supported"),
            zero("no_lookahead", "leaks", "features precede their target season"),
            zero("feature_lineage", "mismatches", "declared and recorded feature seasons agree"),
            zero("feature_lineage_format", "unparsed", "feature seasons are integers"),
            zero("baseline_bias_correction", "unsound", "fitted corrections are converged and interior")]))


def cohort_gate(rows: DataFrame, history: HistoryRules, rules: CalibrationRules) -> DataFrame:
    """Per statistic: exclusions, and sizes of the training and holdout cohorts."""
    def because(reason):
        return F.count_if(F.col("unusable") == reason)

    usable = F.col("unusable").isNull()
    counted = rows.groupBy("stat").agg(
        because("negative_outcome").alias("negative"), because("noninteger_outcome").alias("noninteger"),
        because("invalid_baseline").alias("invalid"), because("impossible_zero_baseline").alias("impossible"),
        because("zero_baseline").alias("zero"), F.count_if(usable & ~F.col("is_holdout")).alias("training"),
        F.count_if(usable & F.col("is_holdout")).alias("holdout"))

    def named(name):
        return F.concat(F.lit("historical_calibration."), F.col("stat"), F.lit("." + name))

    def zero(name, column, message, severity="error"):
        return Check(named(name), F.col(column) == 0, message, severity, {"rows": F.col(column)})

    return check_table(counted, [
        zero("signed_negative_observations", "negative", "signed negative outcomes stay out of the likelihood", "warning"),
        zero("integer_outcomes", "noninteger", "outcomes are integers"),
        zero("baseline_domain", "invalid", "baselines are finite and non-negative"),
        zero("zero_baseline_consistency", "impossible", "zero baselines have zero outcomes"),
        Check(named("training_cohort"), F.col("training") >= history.minimum_player_seasons_per_stat,
              "training cohort meets the minimum", details={"observed": F.col("training")}),
        Check(named("holdout_cohort"), F.col("holdout") >= rules.minimum_holdout_player_seasons_per_stat,
              "holdout cohort meets the minimum", details={"observed": F.col("holdout")})])


def holdout_gate(
    summary: DataFrame, events: DataFrame, coverage: DataFrame, sensitivity: DataFrame, bootstrap: DataFrame,
    fits: DataFrame, rules: CalibrationRules,
) -> DataFrame:
    """Pass/fail tolerances per statistic over small per-statistic tables."""
    worst = (summary.join(events.groupBy("stat").agg(F.max("calibration_gap").alias("gap")), "stat", "left")
             .join(coverage.groupBy("stat").agg(F.max("absolute_error").alias("miss")), "stat", "left")
             .join(sensitivity.groupBy("stat").agg(
                 F.max("log_dispersion_delta").alias("delta"),
                 F.count_if(F.col("status") != "passed").alias("bad_windows")), "stat", "left")
             .join(bootstrap.select("stat", F.col("passed").alias("bootstrap_passed"), "success_rate"), "stat", "left")
             .join(fits.filter("window = 'full'").select("stat", "converged", "bound_hit", "dispersion"), "stat", "left"))
    nll = F.col("negative_log_likelihood_per_player_season")
    limit = F.col("poisson_negative_log_likelihood_per_player_season") + rules.max_holdout_nll_regret_per_player_season

    def named(name):
        return F.concat(F.lit("historical_calibration."), F.col("stat"), F.lit("." + name))

    return check_table(worst, [
        Check(named("optimizer_converged"), F.col("converged"), "dispersion fit converged"),
        Check(named("dispersion_not_on_bound"), ~F.col("bound_hit"), "dispersion is inside its bounds",
              details={"dispersion": F.round("dispersion", 4)}),
        Check(named("bootstrap"), F.col("bootstrap_passed"), "bootstrap gave enough interior fits",
              details={"success_rate": F.col("success_rate")}),
        Check(named("holdout_likelihood"), nll <= limit, "holdout likelihood is within tolerance of Poisson",
              details={"observed": F.round(nll, 4), "maximum": F.round(limit, 4)}),
        Check(named("holdout_brier_calibration"), F.col("gap") <= rules.max_brier_calibration_gap,
              "threshold-event gaps are within tolerance", details={"observed": F.round("gap", 4)}),
        Check(named("holdout_interval_coverage"), F.col("miss") <= rules.max_interval_coverage_error,
              "coverage matches the model-implied mass", details={"observed": F.round("miss", 4)}),
        Check(named("holdout_bias"), F.abs("relative_bias") <= rules.max_abs_relative_bias,
              "aggregate relative bias is within tolerance", details={"observed": F.round("relative_bias", 4)}),
        Check(named("sensitivity_stability"),
              (F.col("bad_windows") == 0) & (F.col("delta") <= rules.max_sensitivity_log_dispersion_delta),
              "historical windows give stable fits", details={"observed": F.round("delta", 4)})])


def dispersion_table(
    rows: DataFrame, fits: DataFrame, bootstrap: DataFrame, summary: DataFrame, gates: DataFrame, rules: CalibrationRules,
) -> DataFrame:
    """Published dispersion per statistic, with its uncertainty, lineage and status."""
    usable = F.col("unusable").isNull()

    def seasons(keep):
        return pipe_join(F.array_sort(F.collect_set(F.when(usable & keep, F.col("target_season")))))

    lineage = rows.groupBy("stat").agg(
        F.count_if(usable & ~F.col("is_holdout")).alias("training_player_seasons"),
        F.count_if(usable & F.col("is_holdout")).alias("holdout_player_seasons"),
        seasons(~F.col("is_holdout")).alias("training_seasons"), seasons(F.col("is_holdout")).alias("holdout_seasons"),
        F.count_if(F.col("unusable") == "negative_outcome").alias("negative_outcomes_excluded"),
        F.count_if(F.col("unusable") == "zero_baseline").alias("zero_baselines_excluded"))
    failed = gates.filter(~F.col("passed") & (F.col("severity") == "error")).select(
        F.get(F.split("name", r"\."), F.lit(1)).alias("stat")).distinct().withColumn("failed", F.lit(True))
    return (fits.filter("window = 'full'").join(lineage, "stat").join(bootstrap.select(
        "stat", "log_dispersion_lower", "log_dispersion_upper", "dispersion_lower", "dispersion_upper", "success_rate"),
        "stat", "left").join(summary, "stat", "left").join(failed, "stat", "left").select(
            "stat", F.lit("negative_binomial").alias("distribution_family"),
            F.lit(rules.calibration_version).alias("calibration_version"), F.lit("historical_only").alias("method"),
            F.col("dispersion").alias("historical_dispersion"), F.col("log_dispersion").alias("historical_log_dispersion"),
            F.col("dispersion_lower").alias("historical_dispersion_lower"),
            F.col("dispersion_upper").alias("historical_dispersion_upper"),
            F.col("log_dispersion_lower").alias("historical_log_dispersion_lower"),
            F.col("log_dispersion_upper").alias("historical_log_dispersion_upper"),
            F.col("dispersion").alias("final_dispersion"), F.lit("historical_only").alias("dispersion_source"),
            "training_player_seasons", "holdout_player_seasons", "training_seasons", "holdout_seasons",
            "negative_outcomes_excluded", "zero_baselines_excluded", "objective_nll",
            F.col("converged").alias("optimizer_converged"), F.col("bound_hit").alias("dispersion_bound_hit"),
            F.col("success_rate").alias("bootstrap_success_rate"),
            F.col("negative_log_likelihood_per_player_season").alias("holdout_nll_per_player_season"),
            F.col("poisson_negative_log_likelihood_per_player_season").alias("holdout_poisson_nll_per_player_season"),
            F.col("relative_bias").alias("holdout_relative_bias"),
            F.col("raw_baseline_relative_bias").alias("holdout_raw_baseline_relative_bias"),
            F.when(F.col("failed"), "failed").otherwise("passed").alias("status")))


def calibrate(predictions: DataFrame, history: HistoryRules, rules: CalibrationRules) -> tuple[DataFrame, DataFrame]:
    """Dispersion table and its check table."""
    rows = cut(window_rows(predictions, history))
    training = cut(training_rows(rows, history))
    fits = cut(fit_dispersion(cut(with_windows(training, history, rules)), ["stat", "window"], rules))
    bootstrap = cut(bootstrap_summary(bootstrap_dispersion(training, fits, rules), rules))
    holdout = cut(holdout_rows(rows, fits.filter("window = 'full'")))
    summary = holdout_summary(holdout)
    gates = cut(all_checks(
        prediction_contract(predictions, history), cohort_gate(rows, history, rules),
        holdout_gate(summary, brier_events(holdout, rules), interval_coverage(holdout, rules),
                     window_sensitivity(fits, history, rules), bootstrap, fits, rules)))
    return dispersion_table(rows, fits, bootstrap, summary, gates, rules), gates
