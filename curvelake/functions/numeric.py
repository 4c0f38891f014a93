"""Scalar column functions: coercion, logits, decay, differences, labels."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 2.2250738585072014e-308
_EPS = 2.220446049250313e-16


def clean_text(c: Column) -> Column:
    """Blank or whitespace-only text becomes NULL."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def safe_double(c: Column) -> Column:
    """Unparseable text becomes NULL instead of an error."""
    return c.try_cast("double")


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))


def null_nonfinite(c: Column) -> Column:
    """NaN and infinities are published as NULL."""
    return F.when(is_finite(c), c)


def logit(p: Column) -> Column:
    """Log-odds, clipped away from 0 and 1; NULL stays NULL."""
    clipped = F.greatest(F.least(p, F.lit(1.0 - _EPS)), F.lit(_TINY))
    return F.when(p.isNotNull(), F.log(clipped) - F.log1p(-clipped))


def half_life_weight(age: Column, half_life: Column | float) -> Column:
    return F.pow(F.lit(0.5), age / (half_life if isinstance(half_life, Column) else F.lit(float(half_life))))


def percent_to_probability(c: Column) -> Column:
    return c.cast("double") / 100.0


def symmetric_abs_difference(a: Column, b: Column) -> Column:
    return 2.0 * F.abs(b - a) / (b + a)


def relative_difference(a: Column, base: Column) -> Column:
    return (a - base) / base


def title_label(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def pipe_join(values: Column) -> Column:
    """Join a list with ``|`` for publishing; an empty list gives an empty string."""
    return F.concat_ws("|", F.transform(values, lambda x: x.cast("string")))


def pipe_ints(c: Column) -> Column:
    """Parse ``2019|2020`` into an integer array; parts that are no integer become NULL."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x) != "")
    return F.transform(parts, lambda x: x.try_cast("int"))


def parse_utc(c: Column) -> Column:
    """ISO-8601 text with an explicit offset to a timestamp; naive or bad text gives NULL."""
    zoned = c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, c.try_cast("timestamp"))


def age_hours(now: Column, then: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / 3.6e9


def two_sided_normal_quantile(level: float) -> float:
    return NormalDist().inv_cdf((1.0 + level) / 2.0)


def prior_log_sd(lower: Column, upper: Column, level: float) -> Column:
    """Standard deviation implied by a central normal interval; NULL unless positive."""
    sd = (upper - lower) / (2.0 * two_sided_normal_quantile(level))
    return F.when(is_finite(sd) & (sd > 0), sd)
