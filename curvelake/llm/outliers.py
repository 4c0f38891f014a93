"""Quality rules with robust multivariate outliers, in DataFrame operations only.

Five statistics of every whole text are transformed to a vector. For every language and source the
minimum-covariance-determinant estimate is sought by concentration steps: the mean and covariance
of the ``share`` of rows nearest so far, in Mahalanobis distance, until rows and estimate settle.
Rows beyond ``cutoff`` are rejected. Distances are counted in narrow bins, so that a group's
quantile needs counts only and no group is sorted or gathered.

Groups of fewer than ``min_group`` rows share one estimate; if they are too few together they
have no verdict of the method. Variances have floors, so that a statistic that is constant in a group
does not make every other value an outlier. Null and empty texts have no words and fail the base
rules. A null language or source is a group like any other. Repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import BLANKS, written

#: Characters counted as symbols (fixed value).
SYMBOLS = "#*$%&|<>"
SPAN = 8
FEATURES = ("f0", "f1", "f2", "f3", "f4")
#: Least standard deviation of each transformed statistic.
FLOORS = (1.0, 0.1, 0.06, 0.7, 0.15)
#: Rows of the concentrated part, and what its covariance is multiplied with for normal rows:
#: 0.75 / P(chi-square with 7 degrees <= its 0.75 quantile with 5 degrees).
SHARE, CONSISTENCY = 0.75, 1.4121
#: Squared distance beyond which a row is rejected: the 0.9999 quantile of chi-square with 5 degrees.
CUTOFF = 25.745
#: Bins per unit of the distance's logarithm.
BINS = 32


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words inside windows of SPAN words that stand in the text twice or more."""
    windows = F.when(F.size(words) >= SPAN, F.transform(
        F.sequence(F.lit(1), F.size(words) - (SPAN - 1)), lambda i: F.xxhash64(F.slice(words, i, SPAN)))).otherwise(F.array().cast("array<bigint>"))

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def twice(rows: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(rows, k)["h"] == F.get(rows, j)["h"], F.lit(False))
            at = F.array_sort(F.transform(F.filter(rows, lambda _, j: same(j, j - 1) | same(j, j + 1)), lambda r: r["i"]))
            return _let(at, lambda a: F.aggregate(
                F.transform(a, lambda x, k: F.least(F.lit(SPAN), F.coalesce(F.get(a, k + 1) - x, F.lit(SPAN)))), F.lit(0), lambda s, x: s + x))
        return _let(ordered, twice)

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of whole texts."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
    found = _let(words, lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        _repeated(w).cast("bigint").alias("n_repeat_words")))
    return docs.select(
        *keep, found.alias("w"), F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")).select(
        *keep, "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")


def features() -> list[Column]:
    """Log length, log word length, root of the symbol share, log of repeated lines, share of repeated words."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    made = (F.log(words), F.log(chars / words), F.sqrt(F.col("n_symbols") / chars), F.log1p("n_dup_lines"), F.col("n_repeat_words") / words)
    return [c.cast("double").alias(f) for c, f in zip(made, FEATURES, strict=True)]


def _inverse(matrix: Column, p: int) -> Column:
    """The inverse of a positive definite matrix in an array, row by row: Gauss-Jordan steps in place."""
    def step(k: int) -> Callable[[Column], Column]:
        def eliminate(a: Column) -> Column:
            at = lambda i, j: F.get(a, F.lit(i * p + j))
            out = []
            for i in range(p):
                for j in range(p):
                    if i == k:
                        out.append(1.0 / at(k, k) if j == k else at(k, j) / at(k, k))
                    else:
                        out.append(-at(i, k) / at(k, k) if j == k else at(i, j) - at(i, k) * at(k, j) / at(k, k))
            return F.array(*out)
        return eliminate
    for k in range(p):
        matrix = _let(matrix, step(k))
    return matrix


def _distance(rows: DataFrame) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance from columns ``mean`` and ``inverse``."""
    p = len(FEATURES)
    away = [F.col(f) - F.get("mean", F.lit(i)) for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i + 1):
            total = total + (1 if i == j else 2) * F.get("inverse", F.lit(i * p + j)) * away[i] * away[j]
    return rows.withColumn("d2", F.when(F.col("mean").isNotNull(), F.greatest(total, F.lit(0.0))))


def _estimate(near: DataFrame) -> DataFrame:
    """``grp, mean, inverse`` of the rows in ``near``; variances below their floors are raised to them."""
    p = len(FEATURES)
    sums = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    sums += [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)]
    cov = [F.col(f"c{max(i, j)}{min(i, j)}") * CONSISTENCY for i in range(p) for j in range(p)]
    for i in range(p):
        cov[i * p + i] = F.greatest(cov[i * p + i], F.lit(FLOORS[i] ** 2))
    return near.groupBy("grp").agg(*sums).select(
        "grp", F.array(*[F.col(f"m{i}") for i in range(p)]).alias("mean"), _inverse(F.array(*cov), p).alias("inverse"))


def _nearest(rows: DataFrame, estimate: DataFrame, share: float) -> DataFrame:
    """``grp, mean, inverse, edge``: the last distance bin needed to hold ``share`` of the group's rows."""
    counts = _binned(rows, estimate).groupBy("grp", "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("grp").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # a row per bin
    edges = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("grp"))).filter(
        F.col("upto") >= F.col("all") * share).groupBy("grp").agg(F.min("bin").alias("edge"))
    return estimate.join(edges, "grp")


def _binned(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    return _distance(rows.join(estimate, "grp")).withColumn("bin", F.floor(F.log(F.greatest("d2", F.lit(1e-9))) * BINS))


def covariances(rows: DataFrame, steps: int = 8, share: float = SHARE) -> DataFrame:
    """``grp, mean, inverse`` after ``steps`` concentration steps over ``rows`` (``grp`` and the features)."""
    # Written, so that Spark sees how small it is and deals no group to one task for the join.
    middle = written(rows.groupBy("grp").agg(*[F.percentile_approx(f, 0.5, F.lit(10_000)).alias(f"m{i}") for i, f in enumerate(FEATURES)]))
    away = rows.join(middle, "grp").groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(FEATURES))],
        *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, F.lit(10_000)).alias(f"s{i}") for i, f in enumerate(FEATURES)])
    p = len(FEATURES)
    scale = [1.0 / F.greatest(F.pow(F.col(f"s{i}") * 1.4826, F.lit(2.0)), F.lit(FLOORS[i] ** 2)) for i in range(p)]
    estimate = written(away.select("grp", F.array(*[F.col(f"m{i}") for i in range(p)]).alias("mean"), F.array(
        *[scale[i] if i == j else F.lit(0.0) for i in range(p) for j in range(p)]).alias("inverse")))
    for _ in range(steps):
        ranked = written(_nearest(rows, estimate, share))
        near = _binned(rows, ranked).filter("bin <= edge")
        estimate = written(_estimate(near))
    return estimate


def rules(docs: DataFrame, cutoff: float = CUTOFF, min_group: int = 200, min_words: int = 20, max_repeat: int = 30, steps: int = 8) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``kept`` and ``distance`` (squared; null without a verdict)."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    keys = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.to_json(F.struct(F.col("lang"), F.col("source"))).alias("own"), "text")
    rows = written(statistics(keys, "doc_id", "own").select("*", failed.alias("base_failed"), *features()))
    sizes = rows.filter(~F.col("base_failed")).groupBy("own").agg(F.count("*").alias("n"))
    # A group of its own from min_group rows on; the others together.
    named = sizes.withColumn("grp", F.when(F.col("n") >= min_group, F.col("own")).otherwise(F.lit("")))
    together = named.groupBy("grp").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_group).select("grp")
    groups = written(named.join(together, "grp").select("own", "grp"))  # a row per language and source
    fitted = written(rows.filter(~F.col("base_failed")).join(groups, "own").select("doc_id", "grp", *FEATURES))
    estimate = covariances(fitted.select("grp", *FEATURES), steps)
    found = written(groups.join(estimate, "grp").drop("grp"))
    judged = _distance(rows.join(found, "own", "left")).withColumnRenamed("d2", "distance")
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")
