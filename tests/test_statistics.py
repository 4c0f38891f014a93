"""Distributions, fits and ranks against direct computation and known answers."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from curvelake.functions import special as S
from curvelake.operators import calibrate, means, ranks
from curvelake.rules import SOURCES, CalibrationRules, MeanRules
from curvelake.session import cut


def direct_survival(k, mu, r):
    return 1 - math.fsum(math.exp(
        math.lgamma(j + r) - math.lgamma(r) - math.lgamma(j + 1) + r * math.log(r / (r + mu)) + j * math.log(mu / (r + mu)))
        for j in range(int(k)))


def test_mass_survival_and_quantile(spark):
    cases = [(3, 2.5, 0.7), (20, 25.0, 1000.0), (900, 850.0, 4.0), (1, 0.5, 0.05)]
    rows = spark.createDataFrame([(float(k), m, r) for k, m, r in cases], "k double, mu double, r double").select(
        "*", S.nb_logpmf(F.col("k"), F.col("mu"), F.col("r")).alias("lp"), S.nb_survival("k", "mu", "r").alias("s"),
        S.nb_quantile(F.lit(0.5), F.col("mu"), F.col("r")).alias("q")).collect()
    for row in rows:
        assert row.s == pytest.approx(direct_survival(row.k, row.mu, row.r), abs=2e-11)
        assert 1 - direct_survival(row.q + 1, row.mu, row.r) >= 0.5
        assert row.q == 0 or 1 - direct_survival(row.q, row.mu, row.r) < 0.5
        log_mass = (math.lgamma(row.k + row.r) - math.lgamma(row.r) - math.lgamma(row.k + 1)
                    + row.r * math.log(row.r / (row.r + row.mu)) + row.k * math.log(row.mu / (row.r + row.mu)))
        assert row.lp == pytest.approx(log_mass, rel=1e-10, abs=1e-10)


def test_inversion_residual_and_unreachable():
    k, p, r = np.array([77.0, 12.0, 2640.0]), np.array([0.37, 0.81, 0.06]), np.array([2.2, 11.0, 0.7])
    t = S.np_invert(k, p, r, np.full(3, 0.01), np.full(3, 10000.0))
    assert np.abs(S.np_survival(k, np.exp(t), r)[0] - p).max() < 1e-9
    assert np.isnan(S.np_invert(np.array([500.0]), np.array([0.9]), np.array([4.0]), np.array([0.01]), np.array([100.0])))[0]


def observations(spark, n=9000, r=6.5, seed=71, season_effect=0.0):
    rng = np.random.default_rng(seed)
    mu = rng.gamma(3.0, 40.0, n) + 5.0
    y = rng.negative_binomial(r, r / (r + mu)).astype(float)
    season = rng.integers(2011, 2015, n)
    y = np.round(y * np.exp(season_effect * (season - 2012.5)))
    return spark.createDataFrame(pd.DataFrame({
        "stat": "s", "window": "full", "season": season, "gsis_player_id": [f"p{i}" for i in range(n)],
        "y": y, "mu": mu, "w": 1.0}))


RULES = CalibrationRules(dispersion_bounds={"s": (0.05, 1000.0)}, bootstrap_samples=200)


def test_dispersion_is_recovered(spark):
    fit = calibrate.fit_dispersion(cut(observations(spark)), ["stat", "window"], RULES).collect()[0]
    assert fit.dispersion == pytest.approx(6.5, rel=0.07) and fit.converged and not fit.bound_hit


def test_bootstrap_agrees_with_drawing_players(spark):
    obs = cut(observations(spark, n=400, seed=3))
    fits = cut(calibrate.fit_dispersion(obs, ["stat", "window"], RULES))
    replicates = calibrate.bootstrap_dispersion(obs, fits, RULES)
    got = calibrate.bootstrap_summary(replicates, RULES).collect()[0]
    frame, rng, grid = obs.toPandas(), np.random.default_rng(0), np.linspace(1.2, 2.6, 281)
    lgamma = np.vectorize(math.lgamma)
    cost = np.stack([-(lgamma(frame.y + r) - math.lgamma(r) + r * np.log(r / (r + frame.mu)) + frame.y * np.log(frame.mu / (r + frame.mu)))
                     for r in np.exp(grid)])
    seasons, draws = sorted(frame.season.unique()), []
    for _ in range(400):
        rows = np.concatenate([rng.choice(np.flatnonzero(frame.season == s), (frame.season == s).sum())
                               for s in rng.choice(seasons, len(seasons))])
        draws.append(grid[cost[:, rows].sum(axis=1).argmin()])
    low, high = np.quantile(draws, [0.05, 0.95])
    assert got.success_rate >= 0.95
    assert got.log_dispersion_lower == pytest.approx(low, abs=0.04)
    assert got.log_dispersion_upper == pytest.approx(high, abs=0.04)


def test_bootstrap_keeps_replicates_far_from_the_full_fit(spark):
    """With strong seasons and very many rows, replicates lie hundreds of standard errors apart."""
    obs = cut(observations(spark, n=60_000, seed=4, season_effect=0.5))
    fits = cut(calibrate.fit_dispersion(obs, ["stat", "window"], RULES))
    got = calibrate.bootstrap_summary(calibrate.bootstrap_dispersion(obs, fits, RULES), RULES).collect()[0]
    assert got.failed_samples == 0 and got.success_rate == 1.0
    assert (got.log_dispersion_upper - got.log_dispersion_lower) * math.sqrt(fits.collect()[0].curvature) > 40


def test_a_task_returns_its_replicates_sums_and_no_row_per_draw(spark):
    obs = cut(observations(spark, n=300, seed=5).repartition(3))
    draws = calibrate.season_draws(obs, RULES).toPandas()
    tickets = {k: (g["ticket"].to_numpy(np.uint64), g["replicate"].to_numpy(np.int64)) for k, g in draws.groupby(["stat", "season"])}
    h1, h2 = calibrate._hash_parts(F.concat_ws("|", "stat", F.col("season").cast("string"), calibrate.ENTITY))
    hashed = cut(obs.withColumns({"h1": h1, "h2": h2}))
    stat = obs.first()["stat"]
    parts = calibrate._drawn_sums(hashed, tickets, {stat: (1.0, 2.0)}, RULES.bootstrap_samples)
    got = parts.toPandas()
    assert len(got) <= 3 * RULES.bootstrap_samples
    rows = hashed.toPandas()
    for replicate in (0, 7, RULES.bootstrap_samples - 1):
        drawn, first, last = 0, 0.0, 0.0
        for _, d in draws[draws.replicate == replicate].iterrows():
            for row in rows[rows.season == d.season].itertuples():
                mixed = (row.h1 + d.ticket * row.h2) % calibrate.HASH_PRIME
                u = (mixed * mixed + d.ticket) % calibrate.HASH_PRIME / calibrate.HASH_PRIME
                times = sum(u >= c for c in calibrate.UNIT_POISSON)
                drawn += times
                first -= times * row.w * float(S.np_nb_logpmf(row.y, row.mu, math.exp(1.0)))
                last -= times * row.w * float(S.np_nb_logpmf(row.y, row.mu, math.exp(2.0)))
        mine = got[got.replicate == replicate]
        assert mine.drawn_rows.sum() == drawn
        assert mine.c0.sum() == pytest.approx(first) and mine[f"c{calibrate.BOOTSTRAP_NODES - 1}"].sum() == pytest.approx(last)


def curve_rows(spark, noise=0.1):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(6):
        ks = np.arange(100, 1500, 100 if c < 5 else 20, dtype=float)
        p = S.np_survival(ks, 600.0 + 40 * c, 4.0)[0]
        z = np.log(p / (1 - p)) + rng.normal(0, noise, len(ks))
        rows += [(f"c{c}", float(k), float(1 / (1 + math.exp(-v))), 4.0, 0.01, 10000.0) for k, v in zip(ks, z)]
    return spark.createDataFrame(rows, "id string, k double, p double, r double, lo double, hi double")


def test_where_a_curve_is_fitted_changes_nothing(spark):
    rows = cut(curve_rows(spark))
    small = means.fit_curves(rows, ["id"], MeanRules(max_curve_quotes_per_task=10**6)).orderBy("id").toPandas()
    large = means.fit_curves(rows, ["id"], MeanRules(max_curve_quotes_per_task=3)).orderBy("id").toPandas()
    for column in ("mean", "objective", "logit_rmse", "logit_mae", "max_abs_logit_residual", "holdout_logit_mae"):
        assert np.allclose(small[column], large[column], rtol=1e-7), column
    for column in ("quotes", "bound_hit", "converged", "holdout_count", "holdout_failed_fits"):
        assert (small[column] == large[column]).all(), column


def test_projections_do_not_depend_on_the_task_limit(spark):
    quotes = cut(model_quotes(spark).unionByName(model_quotes(spark).filter("source_market_id = 'm0-250'").withColumns({
        "source_market_id": F.lit("late"), "canonical_threshold": F.lit(900), "modeling_probability": F.lit(0.9),
        "bid_probability": F.lit(0.89), "ask_probability": F.lit(0.91)})).unionByName(
            model_quotes(spark).filter("canonical_player_id = 'p1'").withColumns({
                "canonical_player_id": F.lit("p9"), "model_inclusion_status": F.lit("excluded"), "model_exclusion_reason": F.lit("wide_spread")})))
    table = history_table(spark, 5.5).withColumns({"final_dispersion": F.col("historical_dispersion"), "dispersion_source": F.lit("historical_only")})
    sources = {"kalshi": SOURCES["kalshi"]}
    few, many = (means.source_projections(quotes, table, sources, MeanRules(max_curve_quotes_per_task=n)).orderBy("canonical_player_id").toPandas()
                 for n in (3, 10**6))
    for column in few:
        if few[column].dtype == float:
            assert np.allclose(few[column], many[column], rtol=1e-7, equal_nan=True), column
        else:
            assert (few[column].fillna("") == many[column].fillna("")).all(), column
    assert set(few.quality_status) == {"passed", "excluded"} and "wide_spread" in set(few.exclusion_reason)
    assert means.projection_lineage(quotes).count() == quotes.count()


def test_exact_curve_mean(spark):
    fit = means.fit_curves(curve_rows(spark, noise=0.0), ["id"], MeanRules()).orderBy("id").toPandas()
    assert np.allclose(fit["mean"], [600.0 + 40 * c for c in range(6)], rtol=1e-8) and fit["logit_rmse"].max() < 1e-8


def model_quotes(spark, r=5.5):
    rows = []
    for i, mean in enumerate((310.0, 420.0, 505.0, 640.0, 730.0, 880.0)):
        for k in (250, 450, 600, 850):
            p = float(S.np_survival(float(k), mean, r)[0])
            rows.append(("run", "2031-32", "kalshi", f"m{i}-{k}", f"p{i}", f"Player {i}", "receiving_yards", k, p,
                         max(p - 0.01, 0.001), min(p + 0.01, 0.999), "2026-08-26T15:00:00Z"))
    frame = spark.createDataFrame(rows, """run_id string, season string, source string, source_market_id string, canonical_player_id string,
        raw_player_name string, stat string, canonical_threshold int, modeling_probability double, bid_probability double, ask_probability double, snapshot_utc string""")
    return frame.withColumns({
        "canonical_player_name": F.col("raw_player_name"), "canonical_position": F.lit("WR"), "inclusion_status": F.lit("included"),
        "model_inclusion_status": F.lit("included"), "model_exclusion_reason": F.lit("")})


def history_table(spark, r):
    return spark.createDataFrame([(
        "receiving_yards", r, math.log(r), r * math.exp(-0.3), r * math.exp(0.3), math.log(r) - 0.3, math.log(r) + 0.3, "passed")],
        """stat string, historical_dispersion double, historical_log_dispersion double, historical_dispersion_lower double,
        historical_dispersion_upper double, historical_log_dispersion_lower double, historical_log_dispersion_upper double, calibration_version string""")


def test_shared_dispersion_updates_and_overrides(spark):
    quotes = cut(model_quotes(spark))
    agreed = means.update_dispersions(quotes, history_table(spark, 6.0), MeanRules()).collect()[0]
    assert agreed.method == "historical_plus_current_market_map"
    assert agreed.current_market_only_dispersion == pytest.approx(5.5, rel=0.03)
    steep = cut(model_quotes(spark, 30.0))
    override = means.update_dispersions(steep, history_table(spark, 5.0), MeanRules()).collect()[0]
    assert override.method == "current_market_conflict_override"
    assert override.final_dispersion == pytest.approx(30.0, rel=0.05)
    few = means.update_dispersions(quotes.filter("canonical_player_id < 'p3'"), history_table(spark, 5.0), MeanRules()).collect()[0]
    assert (few.method, few.fallback_reason) == ("historical_only", "insufficient_eligible_current_market_groups")


def test_one_group_spreads_over_tasks(spark):
    """One group whose first order column is nearly constant: no slice holds much more than its share."""
    df = spark.range(40_000).select(F.lit("g").alias("g"), F.when(F.col("id") < 39_000, 1.0).otherwise(2.0).alias("v"), "id")
    sliced = ranks._with_range(df, ["g"], ["v", "id"], 16)
    most = sliced.groupBy("_range").count().agg(F.max("count")).first()[0]
    assert most < 2 * 40_000 / 16
    ranked = ranks.row_ranks(df, ["g"], ["v", "id"], 16)
    assert ranked.filter(F.col("rank") != F.col("id") + 1).count() == 0 and ranked.count() == 40_000
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g#" in plan and "_range" in plan


def test_ranks_and_quantiles(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"g": rng.integers(0, 2, 500).astype(str), "v": np.round(rng.normal(size=500), 1), "id": range(500)})
    df = spark.createDataFrame(frame)
    got = ranks.exact_quantiles(df, ["g"], "v", [0.25, 0.5]).toPandas().set_index("g")
    for g, part in frame.groupby("g"):
        assert got.loc[g, "q0"] == pytest.approx(part.v.quantile(0.25)) and got.loc[g, "q1"] == pytest.approx(part.v.median())
    ranked = ranks.row_ranks(df, ["g"], ["v", "id"], ranges=8).toPandas().sort_values(["g", "v", "id"])
    assert (ranked["rank"] == ranked.groupby("g").cumcount() + 1).all()
    x = spark.createDataFrame(pd.DataFrame({"x": frame.v, "y": frame.v.abs().round(0)}))
    rho = ranks.spearman(x, "x", "y").collect()[0].rho
    assert rho == pytest.approx(frame.v.rank().corr(frame.v.abs().round(0).rank()))
