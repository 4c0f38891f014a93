"""Over-dispersed count distributions.

Mass functions are plain columns. Survival, quantiles and mean fitting need an
incomplete beta function, so they are small numpy helpers that run on Arrow
batches inside tasks. A negative binomial is given by its mean ``mu`` and its
dispersion ``r`` (variance ``mu + mu**2 / r``).
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lanczos approximation, g = 7, nine terms.
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012,
    9.9843695780195716e-6, 1.5056327351493116e-7,
)
_HALF_LOG_2PI = 0.9189385332046727
# Ship these helpers with the tasks, so that workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY, _EPS = np.finfo(float).tiny, np.finfo(float).eps


def lgamma(x: Column) -> Column:
    """log Gamma(x) for x > 0, inside whole-stage code."""
    series = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:]):
        series = series + F.lit(c) / (x + F.lit(float(i)))
    t = x + F.lit(6.5)
    return F.lit(_HALF_LOG_2PI) + (x - 0.5) * F.log(t) - t + F.log(series)


def nb_probability(mu: Column, r: Column) -> Column:
    return r / (r + mu)


def nb_variance(mu: Column, r: Column) -> Column:
    return mu + mu * mu / r


def nb_logpmf(y: Column, mu: Column, r: Column) -> Column:
    """log P(X = y); a zero mean is the point mass at zero."""
    body = (lgamma(y + r) - lgamma(r) - lgamma(y + 1.0)
            + r * F.log(r / (r + mu)) + y * F.log(mu / (r + mu)))
    at_zero = F.when(y == 0, F.lit(0.0)).otherwise(F.lit(float("-inf")))
    return F.when(mu == 0, at_zero).otherwise(body)


def poisson_logpmf(y: Column, mu: Column) -> Column:
    return y * F.log(mu) - mu - lgamma(y + 1.0)


# --- numpy helpers, used inside tasks -------------------------------------------------

def np_lgamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    shift = np.where(x < 10.0, 10.0, 0.0)
    falling = np.ones_like(x)
    for i in range(10):
        falling = np.where(shift > 0, falling * (x + i), falling)
    z = x + shift
    inv = 1.0 / (z * z)
    stirling = (1 / 12 - inv * (1 / 360 - inv * (1 / 1260 - inv * (1 / 1680 - inv * (1 / 1188))))) / z
    return (z - 0.5) * np.log(z) - z + _HALF_LOG_2PI + stirling - np.log(falling)


def np_nb_logpmf(y, mu, r):
    """log P(X = y); a zero mean is the point mass at zero."""
    with np.errstate(divide="ignore", invalid="ignore"):
        body = np_lgamma(y + r) - np_lgamma(r) - np_lgamma(y + 1.0) + r * np.log(r / (r + mu)) + y * np.log(mu / (r + mu))
    return np.where(mu == 0, np.where(y == 0, 0.0, -np.inf), body)


def _beta_fraction(a, b, x):
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    c, d = np.ones_like(x), 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < 1e-300, 1e-300, d)
    h, live = d.copy(), np.arange(x.size)
    for m in range(1, 20000):
        am, bm, xm = a[live], b[live], x[live]
        dl, cl = d[live], c[live]
        even = m * (bm - m) * xm / ((am + 2 * m - 1) * (am + 2 * m))
        dl = 1.0 + even * dl
        cl = 1.0 + even / cl
        dl = 1.0 / np.where(np.abs(dl) < 1e-300, 1e-300, dl)
        cl = np.where(np.abs(cl) < 1e-300, 1e-300, cl)
        step = dl * cl
        odd = -(am + m) * (am + bm + m) * xm / ((am + 2 * m) * (am + 2 * m + 1))
        dl = 1.0 + odd * dl
        cl = 1.0 + odd / cl
        dl = 1.0 / np.where(np.abs(dl) < 1e-300, 1e-300, dl)
        cl = np.where(np.abs(cl) < 1e-300, 1e-300, cl)
        h[live] *= step * dl * cl
        d[live], c[live] = dl, cl
        going = np.abs(dl * cl - 1.0) > 1e-15
        live = live[going]
        if live.size == 0:
            break
    return h


def _log_beta(a, b):
    """-log B(a, b), which stays the same while a mean is sought; 0 where ``a`` is not positive."""
    out, inside = np.zeros(np.shape(a)), a > 0
    p, q = a[inside], b[inside]
    out[inside] = np_lgamma(p + q) - np_lgamma(p) - np_lgamma(q)
    return out


def regularized_beta(a, b, x, log_x, log_1mx, scale=None):
    """I_x(a, b) and the density factor x**a (1-x)**b / B(a, b); ``scale`` is ``_log_beta`` if it is known."""
    if scale is None:
        scale = np_lgamma(a + b) - np_lgamma(a) - np_lgamma(b)
    density = np.exp(scale + a * log_x + b * log_1mx)
    flip = x >= (a + 1.0) / (a + b + 2.0)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1.0 - x, x)
    part = density * _beta_fraction(p, q, z) / p
    return np.clip(np.where(flip, 1.0 - part, part), 0.0, 1.0), density


def np_survival(k, mu, r, scale=None):
    """P(X >= k) and its derivative in log(mu)."""
    k, mu, r = np.broadcast_arrays(np.asarray(k, float), np.asarray(mu, float), np.asarray(r, float))
    value, slope = np.where(k <= 0, 1.0, 0.0), np.zeros(k.shape)
    live = (k > 0) & (mu > 0)
    if live.any():
        a, m, b = k[live], mu[live], r[live]
        value[live], slope[live] = regularized_beta(
            a, b, m / (m + b), -np.log1p(b / m), -np.log1p(m / b), None if scale is None else scale[live])
    return value, slope


def np_logit(p):
    p = np.clip(p, _TINY, 1.0 - _EPS)
    return np.log(p) - np.log1p(-p)


def _logit_residual(k, target, t, r, scale=None):
    s, slope = np_survival(k, np.exp(t), r, scale)
    inside = np.clip(s, _TINY, 1.0 - _EPS)
    return np_logit(s) - target, slope / (inside * (1.0 - inside))


def np_invert(k, p, r, lo, hi, tolerance=1e-10, scale=None):
    """log-mean solving P(X >= k) = p inside [lo, hi]; NaN where it cannot be reached."""
    k, p, r = (np.asarray(v, float) for v in (k, p, r))
    low_t, high_t = np.log(np.broadcast_to(lo, k.shape)), np.log(np.broadcast_to(hi, k.shape))
    if scale is None:
        scale = _log_beta(k, r)
    low, high = np_survival(k, np.exp(low_t), r, scale)[0] - p, np_survival(k, np.exp(high_t), r, scale)[0] - p
    reachable = (low <= tolerance) & (high >= -tolerance)
    t, a, b = np.clip(np.log(np.maximum(k, 0.5)), low_t, high_t), low_t.copy(), high_t.copy()
    target, live = np_logit(p), np.flatnonzero(reachable)
    for _ in range(200):
        if live.size == 0:
            break
        now = t[live]
        f, slope = _logit_residual(k[live], target[live], now, r[live], scale[live])
        a[live], b[live] = np.where(f < 0, now, a[live]), np.where(f >= 0, now, b[live])
        step = now - f / np.where(slope > 0, slope, np.inf)
        newton = (step >= a[live]) & (step <= b[live]) & (slope > 0)
        t[live] = np.where(newton, step, 0.5 * (a[live] + b[live]))
        live = live[np.abs(t[live] - now) > 1e-13 * np.maximum(1.0, np.abs(now))]
    t = np.where(np.abs(low) <= tolerance, low_t, t)
    t = np.where(np.abs(high) <= tolerance, high_t, t)
    return np.where(reachable, t, np.nan)


def np_fit_curves(k, p, owner, r, lo, hi, root=None, scale=None):
    """One robust log-mean per curve: minimise the soft-L1 cost of logit residuals.

    Quotes are flat arrays; ``owner`` gives each quote's curve. ``r``, ``lo`` and
    ``hi`` are per curve; ``root`` (single-quote log-means) and ``scale`` are
    given together where the caller knows them. The cost's slope is negative left of every single-quote
    root and positive right of them, so the search keeps that bracket.
    """
    n = len(r)
    low, high = np.log(lo), np.log(hi)
    target, rq = np_logit(p), r[owner]
    if root is None:
        scale = _log_beta(k, rq)
        root = np_invert(k, p, rq, lo[owner], hi[owner], 1e-12, scale)
    tol = np.maximum(1e-8, (high - low) * 1e-7)
    interior = np.isfinite(root) & (root - low[owner] > tol[owner]) & (high[owner] - root > tol[owner])
    order = np.lexsort((root, owner))[np.argsort(~interior[np.lexsort((root, owner))], kind="stable")]
    count = np.bincount(owner[interior], minlength=n)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    ranked = root[order]
    mid = 0.5 * (low + high)
    has = count > 0
    t = mid.copy()
    if has.any():
        t[has] = 0.5 * (ranked[(first + (count - 1) // 2)[has]] + ranked[(first + count // 2)[has]])
    a, b, live = low.copy(), high.copy(), np.ones(n, dtype=bool)
    before, g_before = np.full(n, np.nan), np.full(n, np.nan)
    for _ in range(200):
        rows = np.flatnonzero(live[owner])
        mine, now = owner[rows], t.copy()
        f, slope = _logit_residual(k[rows], target[rows], now[mine], rq[rows], scale[rows])
        bend = 1.0 + f * f
        g = np.bincount(mine, f * slope / np.sqrt(bend), minlength=n)
        h = np.bincount(mine, slope * slope / bend**1.5, minlength=n)
        a, b = np.where(live & (g < 0), now, a), np.where(live & (g >= 0), now, b)
        # Secant slope of g once two points are known, else its Gauss-Newton estimate.
        with np.errstate(divide="ignore", invalid="ignore"):
            secant = (g - g_before) / (now - before)
        bend = np.where(np.isfinite(secant) & (secant > 0), secant, h)
        step = now - g / np.where(bend > 0, bend, np.inf)
        newton = (step >= a) & (step <= b) & (bend > 0)
        before, g_before = np.where(live, now, before), np.where(live, g, g_before)
        t = np.where(live, np.where(newton, step, 0.5 * (a + b)), now)
        live &= np.abs(t - now) > 1e-12 * np.maximum(1.0, np.abs(now))
        if not live.any():
            break
    f, _ = _logit_residual(k, target, t[owner], rq, scale)
    quotes = np.maximum(np.bincount(owner, minlength=n), 1)
    size = np.abs(f)
    worst = np.zeros(n)
    np.maximum.at(worst, owner, size)
    return pd.DataFrame({
        "mean": np.exp(t),
        "objective": np.bincount(owner, np.sqrt(1.0 + f * f) - 1.0, minlength=n),
        "logit_rmse": np.sqrt(np.bincount(owner, f * f, minlength=n) / quotes),
        "logit_mae": np.bincount(owner, size, minlength=n) / quotes,
        "max_abs_logit_residual": worst,
        "bound_hit": (t - low <= tol) | (high - t <= tol),
        "converged": ~live,
    })


# --- Arrow column functions -----------------------------------------------------------

@F.pandas_udf(T.DoubleType())
def nb_survival(k: pd.Series, mu: pd.Series, r: pd.Series) -> pd.Series:
    """P(X >= k); NULL where an input is NULL."""
    ok = k.notna() & mu.notna() & r.notna()
    out = np.full(len(k), np.nan)
    out[ok] = np_survival(k[ok], mu[ok], r[ok])[0]
    return pd.Series(out).where(ok.to_numpy(), None)


@F.pandas_udf(T.DoubleType())
def nb_quantile(level: pd.Series, mu: pd.Series, r: pd.Series) -> pd.Series:
    """Smallest integer q with P(X <= q) >= level."""
    level, mu, r = (s.to_numpy(dtype=float) for s in (level, mu, r))
    hi = np.maximum(1.0, np.ceil(mu + 4.0 * np.sqrt(mu + mu * mu / r)))
    while True:
        short = 1.0 - np_survival(hi + 1, mu, r)[0] < level
        if not short.any():
            break
        hi = np.where(short, hi * 2, hi)
    lo = np.full(len(mu), -1.0)
    while (hi - lo > 1).any():
        mid = np.floor((lo + hi) / 2)
        inside = hi - lo > 1
        enough = 1.0 - np_survival(mid + 1, mu, r)[0] >= level
        hi, lo = np.where(inside & enough, mid, hi), np.where(inside & ~enough, mid, lo)
    return pd.Series(hi)


@F.pandas_udf(T.DoubleType())
def beta_tail(a: pd.Series, b: pd.Series, x: pd.Series) -> pd.Series:
    """Regularised incomplete beta I_x(a, b), for 0 < x < 1."""
    a, b, x = (s.to_numpy(dtype=float) for s in (a, b, x))
    inside = (x > 0) & (x < 1)
    out = np.where(x >= 1, 1.0, 0.0)
    if inside.any():
        z = x[inside]
        out[inside] = regularized_beta(a[inside], b[inside], z, np.log(z), np.log1p(-z))[0]
    return pd.Series(np.where(np.isnan(x) | np.isnan(a), np.nan, out))


@F.pandas_udf(T.DoubleType())
def invert_log_mean(k: pd.Series, p: pd.Series, r: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
    """log-mean at which P(X >= k) equals p; NULL if not reachable inside the bounds."""
    args = [s.to_numpy(dtype=float) for s in (k, p, r, lo, hi)]
    usable = np.isfinite(np.stack(args)).all(axis=0)
    usable &= (args[0] >= 1) & (args[1] > 0) & (args[1] < 1)
    out = np.full(len(k), np.nan)
    if usable.any():
        out[usable] = np_invert(*(v[usable] for v in args))
    return pd.Series(out).replace({np.nan: None}).astype("object")


def _struct(*doubles: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.DoubleType()) for name in doubles])


CURVE_FIT = _struct("mean", "objective", "logit_rmse", "logit_mae", "max_abs_logit_residual").add(
    "bound_hit", T.BooleanType()).add("converged", T.BooleanType())
LEFT_OUT = T.StructType().add("count", T.IntegerType()).add("failed", T.IntegerType()).add(
    "logit_mae", T.DoubleType()).add("logit_rmse", T.DoubleType())


def _flat(ks: pd.Series, ps: pd.Series):
    sizes = ks.str.len().to_numpy(dtype=np.int64)
    if not len(ks):
        return np.empty(0), np.empty(0), np.empty(0, dtype=np.int64), sizes
    owner = np.repeat(np.arange(len(ks)), sizes)
    return np.concatenate(ks.to_list()).astype(float), np.concatenate(ps.to_list()).astype(float), owner, sizes


@F.pandas_udf(CURVE_FIT)
def fit_curve(ks: pd.Series, ps: pd.Series, r: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
    """Robust mean of each threshold curve ``(ks, ps)``."""
    k, p, owner, _ = _flat(ks, ps)
    return np_fit_curves(k, p, owner, *(s.to_numpy(dtype=float) for s in (r, lo, hi)))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def curve_cost_profile(ks: pd.Series, ps: pd.Series, log_r: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
    """Best soft-L1 cost of each curve at every log-dispersion node of ``log_r``."""
    k, p, owner, _ = _flat(ks, ps)
    lo, hi = lo.to_numpy(dtype=float), hi.to_numpy(dtype=float)
    nodes = np.exp(np.stack(log_r.to_list()))
    costs = [np_fit_curves(k, p, owner, nodes[:, j], lo, hi)["objective"].to_numpy() for j in range(nodes.shape[1])]
    return pd.Series(list(np.stack(costs, axis=1)))


@F.pandas_udf(LEFT_OUT)
def leave_one_out(ks: pd.Series, ps: pd.Series, r: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
    """Error of each curve's quotes when every quote in turn is left out of the fit."""
    k, p, owner, sizes = _flat(ks, ps)
    r, lo, hi = (s.to_numpy(dtype=float) for s in (r, lo, hi))
    first, error = np.cumsum(sizes) - sizes, np.full(len(k), np.nan)
    held = np.flatnonzero(sizes[owner] > 1)
    # A quote's own root is the same in every fit that it takes part in.
    scale = _log_beta(k, r[owner])
    root = np_invert(k, p, r[owner], lo[owner], hi[owner], 1e-12, scale)
    # One problem per left-out quote; a bounded number of quotes at a time.
    load = np.cumsum(sizes[owner[held]]) // 1_000_000
    for part in np.split(held, np.flatnonzero(np.diff(load)) + 1) if len(held) else []:
        size = sizes[owner[part]]
        problem = np.repeat(np.arange(len(part)), size)
        quote = np.repeat(first[owner[part]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        kept = quote != part[problem]
        curve = owner[part]
        fit = np_fit_curves(k[quote[kept]], p[quote[kept]], problem[kept], r[curve], lo[curve], hi[curve], root[quote[kept]], scale[quote[kept]])
        s = np_survival(k[part], fit["mean"].to_numpy(), r[curve])[0]
        error[part] = np.where(fit["bound_hit"], np.nan, np_logit(s) - np_logit(p[part]))
    good = np.isfinite(error)
    count = np.bincount(owner[good], minlength=len(ks))
    divisor = np.where(count > 0, count, np.nan)
    return pd.DataFrame({
        "count": count, "failed": np.where(sizes > 1, sizes - count, 0),
        "logit_mae": np.bincount(owner[good], np.abs(error[good]), minlength=len(ks)) / divisor,
        "logit_rmse": np.sqrt(np.bincount(owner[good], error[good] ** 2, minlength=len(ks)) / divisor),
    }).astype({"count": "int32", "failed": "int32"}).replace({np.nan: None})


@F.pandas_udf(_struct("f", "slope"))
def logit_residual(k: pd.Series, p: pd.Series, t: pd.Series, r: pd.Series) -> pd.DataFrame:
    """Logit residual of one quote at log-mean ``t`` and its slope."""
    k, p, t, r = (s.to_numpy(dtype=float) for s in (k, p, t, r))
    f, slope = _logit_residual(k, np_logit(p), t, r)
    return pd.DataFrame({"f": f, "slope": slope})


# Points of a curve's summed slope between which it is interpolated, and their weights (barycentric form).
SLOPE_POINTS = np.cos(np.pi * np.arange(65) / 64)
_SLOPE_WEIGHTS = np.where(np.arange(65) % 2, -1.0, 1.0) * np.where(np.isin(np.arange(65), (0, 64)), 0.5, 1.0)


def _interpolated(values, x):
    """Values at ``SLOPE_POINTS`` (one row per problem) read at ``x`` in [-1, 1]."""
    away = x[:, None] - SLOPE_POINTS
    exact = np.abs(away) < 1e-14
    parts = np.where(exact.any(axis=1)[:, None], exact, _SLOPE_WEIGHTS / np.where(exact, 1.0, away))
    return (parts * values).sum(axis=1) / parts.sum(axis=1)


@F.pandas_udf(_struct("slope", "root"))
def left_out_root(k: pd.Series, p: pd.Series, r: pd.Series, a: pd.Series, b: pd.Series, t: pd.Series, slopes: pd.Series) -> pd.DataFrame:
    """Log-mean of a curve without one of its quotes ``(k, p)``.

    ``slopes`` has the whole curve's cost slope at Chebyshev points of [a, b]. The
    search is that of the full fit, from ``t`` on, with the quote's own slope taken
    off. ``slope`` is -1 or 1 if the optimum lies beyond that end, else 0.
    """
    k, p, r, a, b, t = (s.to_numpy(dtype=float) for s in (k, p, r, a, b, t))
    if not len(k):
        return pd.DataFrame({"slope": [], "root": []}, dtype=float)
    values, target = np.stack(slopes.to_list()).astype(float), np_logit(p)
    middle, half = 0.5 * (a + b), np.maximum(0.5 * (b - a), 1e-300)

    def rest(x):
        f, d = _logit_residual(k, target, x, r)
        return _interpolated(values, np.clip((x - middle) / half, -1.0, 1.0)) - f * d / np.sqrt(1.0 + f * f)

    beyond = np.where(rest(a) > 0, -1.0, np.where(rest(b) < 0, 1.0, 0.0))
    low, high, now = a.copy(), b.copy(), np.clip(t, a, b)
    before, g_before = np.full(len(k), np.nan), np.full(len(k), np.nan)
    for _ in range(200):
        g = rest(now)
        low, high = np.where(g < 0, now, low), np.where(g >= 0, now, high)
        with np.errstate(divide="ignore", invalid="ignore"):
            secant = (g - g_before) / (now - before)
            step = now - g / secant
        good = np.isfinite(step) & (secant > 0) & (step > low) & (step < high)
        before, g_before, new = now, g, np.where(good, step, 0.5 * (low + high))
        still = np.abs(new - now) > 1e-12 * np.maximum(1.0, np.abs(now))
        now = np.where(still, new, now)
        if not still.any():
            break
    return pd.DataFrame({"slope": beyond, "root": np.where(beyond < 0, a, np.where(beyond > 0, b, now))})
