import math
import random

import pytest
from pyspark.sql import functions as F

from curvelake.llm import mining

KIND = "vec_id bigint, label int, embedding array<double>, anchor_id int, x string, rank string"


def plain(rows, scale=256, k=5, n=5, low=80, high=100, every=100):
    """All scores, in Python's whole numbers."""
    own = {}
    for name, label, vector in rows:
        if name is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        x = [math.floor(scale * c) for c in vector]
        own[name] = min(own.get(name, (label, x)), (label, x))
    out = []
    for a, (label, x) in own.items():
        if a % every:
            continue
        score = {b: sum(p * q for p, q in zip(x, y, strict=False)) for b, (_, y) in own.items() if b != a}
        best = lambda who: sorted(who, key=lambda b: (-score[b], b))
        for p in best(b for b in score if own[b][0] == label)[:k]:
            inside = [b for b in score if own[b][0] != label and low * score[p] <= high * score[b] <= high * score[p]]
            out += [(a, p, i, b, score[p], score[b]) for i, b in enumerate(best(inside)[:n], 1)]
    return sorted(out)


def mined(spark, rows, every=100, **kw):
    table = spark.createDataFrame([(*r, 1, "c", "d") for r in rows], KIND).repartition(5)
    return sorted(map(tuple, mining.hard_negatives(table, F.col("vec_id") % every == 0, **kw).collect()))


def cloud(count, dims, labels, seed, whole=False):
    rng = random.Random(seed)
    centre = [rng.gauss(0, 1) for _ in range(dims)]
    return [(i, rng.randrange(labels), [rng.randrange(-2, 4) / 8 if whole else (c + rng.gauss(0, 0.7)) / 4 for c in centre]) for i in range(count)]


def test_against_all_scores(spark):
    rows = cloud(600, 8, 4, 1)
    assert plain(rows) and mined(spark, rows) == plain(rows)


def test_ties_and_windows_that_overlap(spark):
    rows = cloud(400, 2, 2, 2, whole=True)
    want = plain(rows, every=20)
    assert len({w[4] for w in want}) < len({w[:2] for w in want})  # positives with equal scores
    assert mined(spark, rows, every=20) == want


def test_small_blocks_and_other_numbers(spark, monkeypatch):
    monkeypatch.setattr(mining, "PIECE", 3)
    rows = cloud(300, 4, 3, 3)
    assert mined(spark, rows, every=10, positives=7, negatives=3, low=1, high=3, scale=10, block=7) == plain(rows, 10, 7, 3, 1, 3, 10)


def test_nulls_repeats_and_odd_vectors(spark):
    rows = cloud(200, 3, 2, 4)
    odd = [(None, 1, [1.0, 1.0, 1.0]), (300, None, [1.0]), (400, 1, None), (500, 1, [1.0, None, 0.0]), (600, 0, [float("nan"), 0.0, 0.0]),
           (700, 1, [float("inf"), 0.0, 0.0]), (800, 1, []), (900, 0, [2.0]), (1000, 1, [0.5, 0.25, 1.0, 3.0]), rows[0], rows[0], (5, 0, [9.0, 9.0, 9.0]), (-100, 1, [0.3, 0.2, 0.9])]
    assert mined(spark, rows + odd) == plain(rows + odd)


def test_huge_entries(spark):
    rows = [(i, i % 2, [1e5 * (1 + i % 5), 2.0**21 * (1 + i % 3)]) for i in range(120)]
    want = plain(rows, every=30)
    assert mined(spark, rows, every=30) == want and max(w[4] for w in want) > 1 << 53
    assert mined(spark, [(0, 1, [1e300]), (1, 1, [1e300]), (2, 2, [-1e308])]) == []


def test_a_crowd_of_equal_vectors(spark):
    rows = [(i, 0 if i < 500 else 1, [0.5, 0.5]) for i in range(1000)] + cloud(50, 2, 2, 5)[1:1]
    assert mined(spark, rows) == plain(rows)


def test_without_partners_or_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])]) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])]) == []


@pytest.mark.parametrize("limit", [0, 1, 4, 5, 101, 2**61 + 3])
def test_lowest(limit):
    least = mining.lowest(limit, 80, 100)
    assert 80 * limit <= 100 * least and 80 * limit > 100 * (least - 1)


def test_suffix_merges():
    slots = [[(9, 1)], [], [(5, 2), (5, 3), (4, 1)], [(1, 7)]]
    assert mining.suffix_merges(slots, 3) == [[(9, 1), (5, 2), (5, 3)], [(5, 2), (5, 3), (4, 1)], [(5, 2), (5, 3), (4, 1)], [(1, 7)]]
