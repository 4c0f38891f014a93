import random

import numpy as np

from curvelake.llm import outliers as O

BLANK = " \t\n\x0b\x0c\r"


def words(text):
    for c in BLANK:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_statistics(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    spans = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    hit = set()
    for i, s in enumerate(spans):
        if spans.count(s) > 1:
            hit.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in O.SYMBOLS for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit)


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = max(1, int(rng.lognormvariate(4, 0.6)))
        own = [rng.choice(["ab", "cde", "fghi", "Größe", "é"]) + str(rng.randrange(60)) for _ in range(size)]
        if rng.random() < 0.12:
            own = [w + rng.choice(["***", "|", "$$"]) for w in own]
        text = ""
        for k, w in enumerate(own):
            text += w + ("\n" if k % 12 == 11 else rng.choice([" ", "  ", "\t"]))
        if rng.random() < 0.2:
            text += "\n".join([" ".join(own[:12])] * rng.randrange(1, 4))
        rows.append((i, text, "en" if i % 3 else "de", "s1" if i % 5 else None))
    return rows


ODD = [(9000, None, "en", "s1"), (9001, "", "en", "s1"), (9002, " \n\t", None, None), (9003, "one two", "en", "s1"), (9004, "a " * 40_000, "en", "s1"),
       (9005, "x\n\nx\n x\ny y\nx", "en", "s1"), (None, "no id " * 3, "en", "s1")]


def test_statistics(spark):
    rows = corpus(150) + ODD[:4] + ODD[5:]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    got = sorted((tuple(r) for r in O.statistics(docs, "doc_id").collect()), key=str)
    assert got == sorted(((d, *plain_statistics(t)) for d, t, _, _ in rows), key=str)


def test_statistics_of_a_long_repeating_text(spark):
    docs = spark.createDataFrame([("a " * 40_000,)], "text string")
    assert tuple(O.statistics(docs).first()) == (40_000, 40_000, 0, 0, 40_000)


def plain_verdicts(rows, steps, min_group):
    """Concentration steps in numpy: inverse by numpy, quantiles by sorting the same bins."""
    stat = {i: plain_statistics(t) for i, (_, t, _, _) in enumerate(rows)}
    failed = {i: s[0] < 20 or 100 * s[4] > 30 * s[0] for i, s in stat.items()}
    x = {i: np.array([np.log(max(1, s[0])), np.log(max(1, s[1]) / max(1, s[0])), np.sqrt(s[2] / max(1, s[1])), np.log1p(s[3]), s[4] / max(1, s[0])]) for i, s in stat.items()}
    own = {i: (r[2], r[3]) for i, r in enumerate(rows)}
    size = {}
    for i, g in own.items():
        if not failed[i]:
            size[g] = size.get(g, 0) + 1
    group = {g: g if n >= min_group else "" for g, n in size.items()}
    verdict = {i: not failed[i] for i in x}
    for name in set(group.values()):
        mine = [i for i in x if not failed[i] and group.get(own[i]) == name]
        if len(mine) < min_group:
            continue
        f = np.array([x[i] for i in mine])
        half = lambda v: np.sort(v)[(len(v) + 1) // 2 - 1]  # noqa: E731  the lower median
        mean = np.array([half(f[:, k]) for k in range(5)])
        mad = np.array([half(np.abs(f[:, k] - mean[k])) for k in range(5)]) * 1.4826
        floors = np.array(O.FLOORS) ** 2
        inverse = np.diag(1 / np.maximum(mad ** 2, floors))
        for _ in range(steps):
            d2 = np.einsum("ni,ij,nj->n", f - mean, inverse, f - mean)
            bins = np.floor(np.log(np.maximum(d2, 1e-9)) * O.BINS)
            edge = np.sort(bins)[int(np.ceil(len(bins) * O.SHARE)) - 1]
            near = f[bins <= edge]
            mean, cov = near.mean(0), np.cov(near.T, bias=True) * O.CONSISTENCY
            cov[np.diag_indices(5)] = np.maximum(np.diag(cov), floors)
            inverse = np.linalg.inv(cov)
        for i in x:
            if group.get(own[i]) == name:
                away = x[i] - mean
                verdict[i] = not failed[i] and away @ inverse @ away <= O.CUTOFF
    return verdict


def test_verdicts_against_numpy(spark):
    rows = corpus(500, 4) + [r for r in ODD if r[0] != 9004]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id int, text string, lang string, source string, distance double").repartition(3)
    got = {r.doc_id: r.kept for r in O.rules(docs, min_group=90, steps=4).collect()}
    want = {rows[i][0]: bool(v) for i, v in plain_verdicts(rows, 4, 90).items()}
    assert got == want
    assert 20 < sum(not v for v in want.values()) < 250


def test_small_and_empty_tables(spark):
    docs = spark.createDataFrame(ODD, "doc_id int, text string, lang string, source string")
    rows = O.rules(docs).collect()
    assert len(rows) == len(ODD) and all(r.kept == (not r.base_failed) and r.distance is None for r in rows)
    assert O.rules(docs.limit(0)).count() == 0
