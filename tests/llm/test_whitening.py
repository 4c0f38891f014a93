import math
import random

import numpy as np
import pytest

from curvelake.llm import whitening

KIND = "vec_id bigint, embedding array<double>, n string, key int, part string, white double"


def table(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, "p", 2.0) for r in rows], KIND).repartition(4)


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and not any(c is None or not math.isfinite(c) for c in v)]


def check(spark, rows, components=32, weights="count", scale=64, shift=1_000_000):
    """Columns against the definitions, in numpy and Python's whole numbers."""
    good = usable(rows)
    dims = max(len(v) for _, v in good)
    x = [[math.floor(scale * c) + shift for c in v] + [shift] * (dims - len(v)) for _, v in good]
    fit = x if weights == "count" else [list(v) for v in {tuple(v) for v in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    apart = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in fit])
    cov = apart.T @ apart / n
    found = whitening.whitened(table(spark, rows), scale=scale, components=components, weights=weights).toPandas()
    wide = min(components, dims)
    assert list(found.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(found) == wide * len(good) and set(found.n) == {n}
    by_row = {}
    for r in found.sort_values("component").itertuples():
        by_row.setdefault(None if np.isnan(r.vec_id) else int(r.vec_id), []).append(r)
    want = {i: sorted(sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for (j, _), v in zip(good, x, strict=True) if i == j) for i, _ in good}
    for i, rs in by_row.items():
        assert sorted(r.deviation for r in rs if r.component == 1) == want[i]
    # The rotation is recovered from the result: it must be made of eigenvectors.
    once = {i: v for (i, _), v in zip(good, x, strict=True) if len(want[i]) == 1 and i is not None}
    rows_in = np.array([[(n * a - s) / n for a, s in zip(once[i], sums, strict=True)] for i in once])
    rows_out = np.array([[r.whitened for r in by_row[i]] for i in once])
    values = np.sort(np.linalg.eigvalsh(cov))[::-1][:wide]
    shares = np.array([r.explained for r in by_row[next(iter(once))]])
    assert np.allclose(shares, values / np.trace(cov), rtol=1e-9)
    turn = np.linalg.lstsq(rows_in, rows_out, rcond=None)[0] * np.sqrt(values)
    assert np.allclose(cov @ turn, turn * values, atol=1e-6 * values[0]) and np.allclose(turn.T @ turn, np.eye(wide), atol=1e-8)
    white = (apart @ turn) / np.sqrt(values)
    error = np.abs(white.T @ white / n - white.mean(0)[:, None] * white.mean(0) - np.eye(wide)).max()
    assert set(found.identity_error) == {found.identity_error[0]} and found.identity_error[0] < 1e-9 and error < 1e-8


def cloud(count, dims, seed):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + j / 3) for j in range(dims)]) for i in range(count)]


def test_against_numpy(spark):
    check(spark, cloud(300, 6, 1))


def test_more_dimensions_than_components(spark):
    check(spark, cloud(300, 40, 2))
    check(spark, cloud(80, 5, 3), components=2)


@pytest.mark.parametrize("weights", ["count", "one"])
def test_copies_weigh_by_count_or_one(spark, weights):
    rows = cloud(60, 4, 4)
    crowd = [(1000 + i, rows[3][1]) for i in range(300)] + [(2000 + i, rows[5][1]) for i in range(9)]
    check(spark, rows + crowd, weights=weights)


def test_nulls_repeats_and_short_vectors(spark):
    rows = cloud(80, 3, 5)
    odd = [(500, None), (501, [1.0, None, 2.0]), (502, [float("nan")] * 3), (503, [1.0, float("-inf"), 0.0]), (504, []), (505, [2.0]), (None, [0.1, 0.2, 0.3]),
           rows[1], (2, [5.0, 5.0, 5.0]), (-7, [-3.2, 0.0, 40.0])]
    check(spark, rows + odd)


def test_wide_entries(spark):
    check(spark, [(i, [c * 3000 for c in v]) for i, v in cloud(100, 3, 6)])
    big = whitening.whitened(table(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 7.0])])).toPandas()
    assert len(big) == 6 and big[big.vec_id == 1].deviation.isna().all()


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]
    found = whitening.whitened(table(spark, rows)).toPandas()
    assert found[found.component == 1].whitened.notna().all() and found[found.component > 1].whitened.isna().all()
    assert (found[found.component > 1].explained == 0).all() and (found.identity_error < 1e-9).all()
    same = whitening.whitened(table(spark, [(1, [1.0]), (2, [1.0])])).toPandas()
    assert same.whitened.isna().all() and same.identity_error.isna().all() and set(same.deviation) == {0}


def test_empty(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, None), (2, [])])).columns[0] == "vec_id"


def test_sums_are_exact_beyond_64_bits():
    rows = np.array([[1 << 52, -5], [3, 7]], np.int64)
    sums = np.array([(1 << 70) + 1, 2], object)
    assert whitening.centred(rows, 1 << 20, sums).tolist() == [[(1 << 72) - (1 << 70) - 1, -5 * (1 << 20) - 2], [3 * (1 << 20) - (1 << 70) - 1, 7 * (1 << 20) - 2]]
