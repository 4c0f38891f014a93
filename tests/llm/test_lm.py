import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curvelake.llm import lm


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w.encode() for w in low.split(" ") if w] + [lm.END]


def fold(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0


def corpus(n=240):
    rng = random.Random(2)
    kinds = [["the", "of", "and", "houses", "running", "Walking"], ["der", "die", "und", "Größung", "haltung"], ["le", "la", "et", "maisons"]]
    rows = []
    for i in range(n):
        own = rng.choice(kinds)
        rows.append((i, rng.choice([" ", "\n"]).join(rng.choice(own) if rng.random() < 0.9 else f"rare{rng.randrange(200)}" for _ in range(rng.randrange(60)))))
    return rows + [(500, None), (501, ""), (502, " \n"), (None, "the end"), rows[3], (503, "unknown " * 9000)]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id int, text string, score string").repartition(3)
    own = docs.selectExpr("cast(doc_id as bigint) doc_id", "false held_out", "text")
    train = [r for r in rows if not fold(r[0])]
    learned = spark.createDataFrame(train, "doc_id bigint, text string")
    return rows, docs, own, train, lm.fit(learned, top=10)


def test_counts_and_base_score(spark, fitted):
    rows, docs, *_ = fitted
    count = Counter(w for d, t in rows if not fold(d) for w in words(t))
    total, distinct = sum(count.values()), len(count)
    want = sorted((-1 if d is None else d, fold(d), len(words(t)), sum(w in count for w in words(t)), total,
                   sum(log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words(t))) for d, t in rows)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in lm.scores(docs, top=10).collect())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def plain_log10(model, count, history, word):
    """One token: softmax over classes, then the word's share of its class."""
    known = lm.Vocabulary()
    number = known.take([*history, word])
    token, sizes = number, np.array([len(number)])
    feature = model.features(known, token, sizes)[:, -1]
    logit = model.base.astype(float) + sum(model.weight[f].astype(float) for f in feature)
    p = np.exp(logit - logit.max())
    c = model.classes[known.endings[number[-1]]]
    return log10(p[c] / p.sum()) + log10(count.get(word, 0) + 0.1) - model.mass[c]


def test_scores_token_by_token(spark, fitted):
    rows, _, own, train, fit = fitted
    count = Counter(w for _, t in train for w in words(t))
    got = {r.doc_id: r.score for r in lm.score_with(own, fit).collect() if r.doc_id is not None}
    for doc, text in rows[:40] + rows[240:243]:
        w = words(text)
        want = sum(plain_log10(fit.model, count, w[max(0, i - 2):i], w[i]) for i in range(len(w)))
        assert abs(got[doc] - want) < 1e-3 * max(1, abs(want)), doc


def test_probabilities_of_all_words_add_up_to_one(fitted):
    *_, train, fit = fitted
    count = Counter(w for _, t in train for w in words(t))
    seen = sum(10 ** plain_log10(fit.model, count, [b"the", b"of"], w) for w in count)
    known = lm.Vocabulary()
    numbers = known.take(list(count))
    classes = set(fit.model.classes[known.endings[numbers]])
    # What is left is the share of unknown words of each class.
    left = 0.0
    number = known.take([b"the", b"of", lm.END])
    feature = fit.model.features(known, number, np.array([3]))[:, -1:]
    for c in range(lm.CLASSES):
        p = np.exp(fit.model.log_probability(feature, np.array([c])))[0]
        left += p * 0.1 / 10 ** fit.model.mass[c] if c in classes else p
    assert abs(seen + left - 1) < 1e-4


def test_training_beats_the_class_shares_on_held_out_texts(spark, fitted):
    rows, docs, *_ = fitted
    found = [r for r in lm.scores(docs).collect() if r.held_out and r.n_tokens > 10]
    assert len(found) > 8
    assert sum(r.score for r in found) > sum(r.base_score for r in found) + 0.1 * sum(r.n_tokens for r in found)


def test_the_gradient_step_is_the_softmax_gradient():
    model = lm.Model(np.arange(lm.ENDINGS) % lm.CLASSES, np.zeros(lm.CLASSES, np.float32), np.zeros(lm.CLASSES), np.zeros((lm.KINDS * lm.FEATURES, lm.CLASSES), np.float32))
    class Held:
        value = model
    text = "one two three one two"
    batch = next(lm._follow(iter([pa.RecordBatch.from_pydict({"text": [text]})]), Held))
    known = lm.Vocabulary()
    token, sizes = known.texts([text])
    feature, target = model.features(known, token, sizes), model.classes[known.endings[token]]
    grad = np.zeros((lm.KINDS * lm.FEATURES, lm.CLASSES))
    for f, t in zip(feature.T, target, strict=True):
        grad[f] += 1 / lm.CLASSES
        grad[f, t] -= 1
    at = batch["feature"].to_numpy()
    assert set(at) == set(feature.reshape(-1))
    want = -lm.RATE * grad[at] / np.sqrt(1 + (grad[at] ** 2).sum(1, keepdims=True))
    got = np.stack([batch[f"w{c}"].to_numpy() for c in range(lm.CLASSES)], 1) / batch["seen"].to_numpy()[:, None]
    assert np.allclose(got, want, atol=1e-5)


def test_empty_and_untrained(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert lm.scores(docs).count() == 0
    held = next(i for i in range(100) if fold(i))
    row = lm.scores(spark.createDataFrame([(held, "one two")], "doc_id int, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and abs(row.base_score) < 1e-9


def test_small_batches_give_the_same_vocabulary(spark):
    text = [" ".join(f"w{i % 97}" for i in range(500)), None, "w1"]
    batch = pa.RecordBatch.from_pydict({"text": text})
    def total(kept):
        out = Counter()
        for b in lm._counts(iter([batch.slice(i, 1) for i in range(3)]), kept):
            for r in b.to_pylist():
                out[r["hash"], r["ending"], r["pair"]] += r["n"]
        return out
    assert total(10) == total(1 << 20)


def test_a_word_that_only_the_two_before_it_tell_is_learned(spark):
    """The third word of a triple is told by neither of the two before it alone, so bigram and skip features can't learn it."""
    rng = random.Random(4)
    def triples():
        for _ in range(60):
            a, b = rng.randrange(2), rng.randrange(2)
            yield ["xaaa", "xbbb"][a] + " " + ["yccc", "yddd"][b] + " " + ["zeee", "zfff"][a ^ b]
    docs = spark.createDataFrame([(i, " ".join(triples())) for i in range(600)], "doc_id bigint, text string").repartition(2)
    found = lm.scores(docs).filter("held_out").selectExpr("sum(score) score", "count(*) n").first()
    assert found.n > 30
    # One bit each for the first two words of a triple and nothing for the third; half a bit more is allowed.
    assert found.score / (found.n * 60) > -2.5 * log10(2)


def test_scores_do_not_depend_on_partitions(spark):
    """The same rows in 1 and in 64 partitions, over several shards and with repeated rows and rows without an id."""
    rows = corpus() + [(None, None), (None, "the end"), (7, "der die und")] * 3
    own = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "false held_out", "text")
    def found(parts):
        table = own.repartition(parts)
        got = lm.score_with(table, lm.fit(table.select("doc_id", "text"), top=50, shard=800)).collect()
        return sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    one, many = found(1), found(64)
    assert [r[:3] for r in one] == [r[:3] for r in many]
    assert np.allclose([r[3:] for r in one], [r[3:] for r in many], rtol=0, atol=1e-6)


def test_steps_do_not_depend_on_arrow_batches():
    rng = np.random.default_rng(3)
    model = lm.Model(np.arange(lm.ENDINGS) % lm.CLASSES, np.zeros(lm.CLASSES, np.float32), np.zeros(lm.CLASSES), np.zeros((lm.KINDS * lm.FEATURES, lm.CLASSES), np.float32))
    class Held:
        value = model
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(f"w{x}" for x in rng.integers(0, 300, 40)) for _ in range(150)]})
    whole = next(lm._follow(iter([batch]), Held))
    cut = next(lm._follow(iter([batch.slice(i, 11) for i in range(0, 150, 11)]), Held))
    assert whole.equals(cut)
    assert sum(whole["seen"].to_pylist()) == 150 * 41 * lm.KINDS


def test_sums_of_runs():
    rng = np.random.default_rng(1)
    sizes = np.r_[rng.integers(1, 12, 50), 1, 8, 9, 300]
    first = np.cumsum(sizes) - sizes
    values = rng.normal(size=(sizes.sum(), 5))
    assert np.allclose(lm._sums(values, first, sizes), np.add.reduceat(values, first, axis=0))


def test_clashing_columns_and_a_very_long_text(spark):
    rows = [(1, "Aa " * 200_000, "row", 5), (2, "aa bb", None, 6), (2, "aa bb", None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, key long")
    got = sorted((r.doc_id, r.n_tokens) for r in lm.scores(docs.withColumnRenamed("row", "hash").withColumn("part", F.lit(1))).collect())
    assert got == [(1, 200_001), (2, 3), (2, 3)]
