"""Work that gates and fits do once: roots of quotes, profiles of brackets, columns that a gate reads."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvelake.functions import special as S
from curvelake.operators import calibrate, history, history_gates, means
from curvelake.operators.checks import all_checks
from curvelake.plans import roles as R



def history_tables(spark, folder):
    """Orders of 60 customers in every month of the seasons, with their lines."""
    at = F.make_timestamp(F.col("id") % 6 + 1995, F.lit(1) + F.col("id") % 12, F.lit(5), F.lit(0), F.lit(0), F.lit(0))
    rows = spark.range(60 * 72).select(
        F.col("id").alias("o_orderkey"), F.expr("id div 72").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        at.alias("o_orderdate"), F.concat(F.lit("T"), F.col("id") % 3).alias("o_orderpriority"))
    rows.write.parquet(f"{folder}/orders.parquet")
    spark.range(60).select(F.col("id").alias("c_custkey"), F.concat(F.lit("C"), F.col("id")).alias("c_name"), F.concat(F.lit("P"), F.col("id") % 4).alias("c_mktsegment")).write.parquet(
        f"{folder}/customer.parquet")
    spark.range(60 * 144).select(
        F.expr("id div 2").alias("l_orderkey"), (F.pmod(F.xxhash64("id"), F.lit(9)) + 1).cast("double").alias("l_quantity"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag")).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_left_out_fits_solve_each_quote_once(monkeypatch):
    solved, plain = [], S.np_invert
    monkeypatch.setattr(S, "np_invert", lambda k, *a, **b: (solved.append(len(k)), plain(k, *a, **b))[1])
    ks, ps = [[2.0, 5.0, 9.0, 14.0], [3.0], [4.0, 8.0, 12.0]], [[0.9, 0.6, 0.35, 0.1], [0.5], [0.7, 0.5, 0.2]]
    r = pd.Series([1.0, 2.0, 0.7])
    lo, hi = pd.Series([0.01] * 3), pd.Series([5000.0] * 3)
    out = S.leave_one_out.func(pd.Series(ks), pd.Series(ps), r, lo, hi)
    assert sum(solved) == 8
    assert out["count"].to_list() == [4, 0, 3]
    for i in (0, 2):
        error = []
        for j in range(len(ks[i])):
            k, p = np.delete(ks[i], j), np.delete(ps[i], j)
            fit = S.np_fit_curves(k, p, np.zeros(len(k), int), r[i:i + 1].to_numpy(), lo[:1].to_numpy(), hi[:1].to_numpy())
            error.append(abs(S.np_logit(S.np_survival(ks[i][j], fit["mean"][0], r[i])[0]) - S.np_logit(np.array(ps[i][j]))))
        assert abs(out["logit_mae"][i] - np.mean(error)) < 1e-12


def test_variants_share_the_profile_of_a_bracket(spark, monkeypatch):
    curves = 12
    rows = spark.createDataFrame([
        ("quantity", f"p{i}", float(k), float(np.round(S.np_survival(k, 6.0 + i, 1.0)[0], 4))) for i in range(curves) for k in (2, 6, 11)],
        "stat string, canonical_player_id string, k double, p double")
    priors = spark.createDataFrame([("quantity", "market", 0.0, None), ("quantity", "map", 0.1, 0.2)], "stat string, variant string, prior_log double, prior_sd double")
    seen, plain = spark.sparkContext.accumulator(0), S.curve_cost_profile.func

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def counted(ks: pd.Series, ps: pd.Series, log_r: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        seen.add(len(ks))
        return plain(ks, ps, log_r, lo, hi)

    monkeypatch.setattr(means, "curve_cost_profile", counted)
    found = {r["variant"]: r["dispersion"] for r in means.shared_dispersion(rows, priors, R.MEANS).collect()}
    assert abs(found["market"] - 1.0) < 0.05 and abs(found["map"] - 1.0) < 0.1
    # Three rounds; the variants' first bracket is the same.
    assert 0 < seen.value <= 5 * curves, (seen.value, found)


def test_gates_read_no_more_than_their_columns(spark, tmp_path):
    folder = history_tables(spark, tmp_path)
    whole, h = R.predictions(spark, folder), R.HISTORY
    assert whole.filter("training_eligible").count() > 0
    lags = [f"lag_{i}_season" for i in range(1, history.LAGS_PUBLISHED + 1)]
    for reads, gate in (
            (history_gates.PREDICTION_READS, lambda p: history_gates.prediction_gate(p, h)),
            ([*calibrate.PREDICTION_READS, *lags], lambda p: all_checks(
                calibrate.prediction_contract(p, h), calibrate.cohort_gate(calibrate.window_rows(p, h), h, R.CALIBRATION)))):
        some = R.predictions_for(spark, folder, reads)
        assert some.columns == list(reads) and some.count() == whole.count()
        assert sorted(map(str, gate(some).collect())) == sorted(map(str, gate(whole).collect()))
