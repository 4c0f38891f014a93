import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from curvelake.llm import classifier
from curvelake.llm.common import table

SMALL = "/root/testdata/sf0.01"


def plain_score(text, net):
    """Chunk by chunk and filter by filter."""
    body = list((text or "").encode())
    width, step, size = classifier.WIDTH, classifier.STEP, classifier.CHUNK
    n = max(1, -(-max(0, len(body) - (width - step)) // size))
    body += [classifier.PAD] * (n * size + width - step - len(body))
    rows = []
    for c in range(n):
        part = body[c * size:(c + 1) * size + width - step]
        best = np.full(classifier.FILTERS, -np.inf)
        for i in range(0, len(part) - width + 1, step):
            best = np.maximum(best, net["embed"][part[i:i + width]].reshape(-1).astype(float) @ net["filter"])
        rows.append(np.maximum(best + net["shift"], 0))
    h = np.tanh(np.r_[np.max(rows, 0), np.mean(rows, 0)] @ net["dense"] + net["dense_shift"])
    return 1 / (1 + np.exp(-float(h @ net["last"][:, 0] + net["last_shift"][0])))


TEXTS = [None, "", "a", "Some words. " * 10, "x" * 1036, "x" * 1037, "é" * 3000, "abc " * 2000]


def test_scores_cover_every_byte():
    net = classifier.new_network(3)
    assert np.allclose(classifier.scores(TEXTS, net), [plain_score(t, net) for t in TEXTS], atol=1e-4)
    changed = "abc " * 1999 + "ab#!"
    assert not np.array_equal(classifier.pooled(classifier.chunks(changed), net)[0], classifier.pooled(classifier.chunks("abc " * 2000), net)[0])


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in classifier.new_network(1).items()}
    parts = [classifier.chunks(t) for t in TEXTS[2:]]
    label, weight = np.array([0, 1, 0, 1, 1, 0.0]), rng.random(6)

    def loss(own):
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        p = classifier._combine(classifier.pooled(np.concatenate(parts), own)[0], starts, own)[3]
        return float(-(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() / weight.sum())
    grad = classifier._gradient(parts, label, weight, net)
    for name in ("filter", "shift", "dense", "dense_shift", "last", "last_shift"):
        for at in rng.integers(0, net[name].size, 3):
            moved = {k: v.copy() for k, v in net.items()}
            moved[name].reshape(-1)[at] += 1e-5
            up = loss(moved)
            moved[name].reshape(-1)[at] -= 2e-5
            assert abs((up - loss(moved)) / 2e-5 - grad[name].reshape(-1)[at]) < 2e-3, name


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    return classifier.quality(docs, labels).cache(), labels


def test_held_out_rows(scored):
    found, _ = scored
    rows = found.collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_accuracy(scored):
    found, labels = scored
    rows = found.filter("held_out").join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert len(rows) > 60 and np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "text", "x"), (2, "", "x")], "doc_id int, text string, quality string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (2, 7)], "doc_id int, quality int")
    got = classifier.quality(docs, labels).collect()
    assert len(got) == 4 and all(r.score == 0.5 and r.predicted == 0 for r in got)
    both = spark.createDataFrame([(1, 1), (1, 0), (1, 1)], "doc_id int, quality int")  # a contradiction
    assert classifier.quality(docs, both).count() == 4
    assert classifier.quality(docs.limit(0), labels.limit(0)).count() == 0


def test_a_very_long_text_trains_in_bounded_memory():
    texts = [b"some words of a clean text. " * 750_000, b"## $$ %%", b"short"]
    assert len(texts[0]) > 20_000_000
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    net = classifier.train(texts, [1, 0, 1], epochs=1)
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert peak < 300e6
    assert all(np.isfinite(v).all() for v in net.values())


def test_gradient_does_not_depend_on_pieces(monkeypatch):
    net = classifier.new_network(2)
    parts = [classifier.chunks(t * 9 if t else t) for t in TEXTS]
    label, weight = np.arange(len(parts)) % 2, np.ones(len(parts))
    whole = classifier._gradient(parts, label, weight, net)
    monkeypatch.setattr(classifier, "PIECE", 3)
    cut = classifier._gradient(parts, label, weight, net)
    assert whole.keys() == cut.keys() == net.keys()
    assert all(np.allclose(whole[k], cut[k], rtol=1e-4, atol=1e-6) for k in net)


def test_text_of_the_least_hash_teaches_and_bytes_are_bounded(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, c * 100) for i in ids for c in "ab"], "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id int, quality int")
    seen = []

    def keep(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        yield pa.RecordBatch.from_pydict({"net": pa.array([repr(sorted((r["doc_id"], r["quality"], r["body"]) for r in rows)).encode()], pa.binary())})
    monkeypatch.setattr(classifier, "_fit", keep)
    monkeypatch.setattr(classifier.np, "load", lambda file: seen.append(eval(file.getvalue())) or {})
    for parts in (1, 7):
        classifier.fit(docs.repartition(parts), labels.repartition(parts))
    classifier.fit(docs, labels, max_bytes=1000)
    assert seen[0] == seen[1] and [r[0] for r in seen[0]] == ids
    assert len({r[2] for r in seen[0]}) == 1
    assert sorted(r[1] for r in seen[2]) == [0] * 5 + [1] * 5 and set(seen[2]) < set(seen[0])


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(i, ["good words here", "## $$"][i % 2], 5, b"x", 1) for i in range(40)], "doc_id int, text string, quality int, body binary, before int")
    labels = spark.createDataFrame([(i, 1 - i % 2, "y") for i in range(40)], "doc_id int, quality int, text string")
    found = classifier.quality(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == 40
