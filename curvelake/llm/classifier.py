"""Quality classifier: a convolutional network over bytes, in numpy.

Bytes become short vectors; learned filters run over them in strides, in overlapping chunks that
cover the whole text. Each chunk keeps every filter's maximum; the document keeps the maximum and
the mean of its chunks, and two dense layers make one probability of them.

The network is fitted on at most ``max_train`` labelled documents (whole texts, chosen by a hash of
the id), no more than fill ``max_bytes``. A null or empty text is one chunk of padding. Very long texts
are whole in training and scoring; some four bytes a byte of the longest are held, as filters run over
pieces of chunks. Without labels of both kinds every score is 0.5. Repeated rows get repeated results;
of several texts under one id the one of the least hash teaches; labels that contradict each other both
teach. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import bucket_of, map_slices, slices

#: Bytes of a filter, of its step and of a chunk; neighbouring chunks share a filter's width.
WIDTH, STEP, CHUNK = 16, 4, 1024
#: Chunks whose windows are held at a time.
PIECE = 64
FILTERS, EMBEDDED, HIDDEN = 32, 4, 16
PAD = 256
THRESHOLD = 0.7


def chunks(text: str | bytes | None) -> np.ndarray:
    """One row of byte numbers per chunk, padded at the end; rows overlap by ``WIDTH - STEP`` bytes."""
    body = np.frombuffer(text if isinstance(text, bytes) else (text or "").encode(), np.uint8)
    reach = CHUNK + WIDTH - STEP
    n = max(1, -(-max(0, len(body) - (WIDTH - STEP)) // CHUNK))
    padded = np.full(n * CHUNK + WIDTH - STEP, PAD, np.int16)
    padded[:len(body)] = body
    return np.lib.stride_tricks.as_strided(padded, (n, reach), (CHUNK * padded.itemsize, padded.itemsize))


def new_network(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, size: rng.normal(0, size, shape).astype(np.float32)
    return {"embed": normal(257, EMBEDDED, size=0.5), "filter": normal(WIDTH * EMBEDDED, FILTERS, size=(WIDTH * EMBEDDED) ** -0.5),
            "shift": np.zeros(FILTERS, np.float32), "dense": normal(2 * FILTERS, HIDDEN, size=(2 * FILTERS) ** -0.5),
            "dense_shift": np.zeros(HIDDEN, np.float32), "last": normal(HIDDEN, 1, size=HIDDEN ** -0.5), "last_shift": np.zeros(1, np.float32)}


def _pieces(parts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The chunks of all texts in order, some PIECE at a time."""
    held, n = [], 0
    for part in parts:
        for at in range(0, len(part), PIECE):
            held.append(part[at:at + PIECE])
            n += len(held[-1])
            if n >= PIECE:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _windows(part: np.ndarray, net: dict) -> np.ndarray:
    """[chunks, windows, WIDTH * EMBEDDED] of embedded bytes."""
    held = net["embed"][part].reshape(len(part), -1)
    n = CHUNK // STEP
    strides = (held.strides[0], STEP * EMBEDDED * held.itemsize, held.itemsize)
    return np.ascontiguousarray(np.lib.stride_tricks.as_strided(held, (len(part), n, WIDTH * EMBEDDED), strides))


def pooled(part: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray]:
    """Each chunk's maximum of every filter, and the window where it stands."""
    seen = _windows(part, net).reshape(-1, WIDTH * EMBEDDED) @ net["filter"]
    seen = seen.reshape(len(part), -1, FILTERS)
    return seen.max(1), seen.argmax(1)


def _maxima(part: np.ndarray, net: dict) -> np.ndarray:
    seen = _windows(part, net).reshape(-1, WIDTH * EMBEDDED) @ net["filter"]
    return seen.reshape(len(part), -1, FILTERS).max(1)


def _combine(maxima: np.ndarray, starts: np.ndarray, net: dict) -> tuple[np.ndarray, ...]:
    """Activations, document features, hidden layer and probability."""
    active = np.maximum(maxima + net["shift"], 0)
    sizes = np.diff(np.r_[starts, len(active)])[:, None].astype(np.float32)
    feature = np.hstack([np.maximum.reduceat(active, starts), np.add.reduceat(active, starts) / sizes])
    hidden = np.tanh(feature @ net["dense"] + net["dense_shift"])
    logit = (hidden @ net["last"] + net["last_shift"])[:, 0]
    return active, feature, hidden, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def scores(texts: list[str | None], net: dict) -> np.ndarray:
    parts = [chunks(t) for t in texts]
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    maxima = np.concatenate([_maxima(rows, net) for rows in _pieces(parts)])
    return _combine(maxima, starts, net)[3]


def _gradient(parts: list[np.ndarray], label: np.ndarray, weight: np.ndarray, net: dict) -> dict[str, np.ndarray]:
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    found = [(most, at.astype(np.int16)) for most, at in (pooled(rows, net) for rows in _pieces(parts))]
    maxima, where = (np.concatenate(x) for x in zip(*found, strict=True))
    active, feature, hidden, p = _combine(maxima, starts, net)
    sizes = np.diff(np.r_[starts, len(maxima)])
    owner = np.repeat(np.arange(len(starts)), sizes)
    d_logit = ((p - label) * weight / weight.sum())[:, None].astype(np.float32)
    out = {"last": hidden.T @ d_logit, "last_shift": d_logit.sum(0)}
    d_hidden = d_logit @ net["last"].T * (1 - hidden ** 2)
    out |= {"dense": feature.T @ d_hidden, "dense_shift": d_hidden.sum(0)}
    d_feature = d_hidden @ net["dense"].T
    top = active == feature[owner, :FILTERS]
    shares = np.add.reduceat(top.astype(np.float32), starts)
    d_active = top * (d_feature[:, :FILTERS] / shares)[owner] + (d_feature[:, FILTERS:] / sizes[:, None])[owner]
    d_max = (d_active * (active > 0)).astype(np.float32)
    out |= {"filter": np.zeros_like(net["filter"]), "shift": d_max.sum(0), "embed": np.zeros_like(net["embed"])}
    # Only the winning window of each chunk and filter has a gradient.
    begin = 0
    for rows in _pieces(parts):
        own = slice(begin, begin + len(rows))
        begin += len(rows)
        at = where[own, :, None].astype(np.int64) * STEP + np.arange(WIDTH)
        winner = rows[np.arange(len(rows))[:, None, None], at]
        seen = net["embed"][winner].reshape(len(rows), FILTERS, -1)
        out["filter"] += np.einsum("cf,cfk->kf", d_max[own], seen)
        d_seen = (d_max[own, :, None] * net["filter"].T[None]).reshape(-1, EMBEDDED)
        flat = winner.reshape(-1)
        out["embed"] += np.stack([np.bincount(flat, d_seen[:, e], 257) for e in range(EMBEDDED)], 1).astype(np.float32)
    return out


def train(texts: list[str | bytes | None], labels: list[int], epochs: int = 16, batch: int = 32, rate: float = 0.01) -> dict[str, np.ndarray]:
    """Adam over shuffled batches; both labels weigh the same."""
    net, rng = new_network(), np.random.default_rng(1)
    label = np.array(labels, np.float32)
    share = label.mean()
    weight = np.where(label > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    first, second, step = {k: 0.0 for k in net}, {k: 0.0 for k in net}, 0
    total = epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            grad = _gradient([chunks(texts[i]) for i in own], label[own], weight[own], net)
            step += 1
            pace = rate * (1 - (step - 1) / total)
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] = net[k] - (pace * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The network of all rows (``doc_id, quality, body``), or nothing without both labels."""
    found = (r for piece in slices(batches) for r in zip(*(c.to_pylist() for c in piece.columns), strict=True))
    rows = sorted(found, key=lambda r: str(r[:2]))
    if len({r[1] for r in rows}) == 2:
        file = io.BytesIO()
        np.savez(file, **train([r[2] for r in rows], [r[1] for r in rows]))
        yield pa.RecordBatch.from_pydict({"net": pa.array([file.getvalue()], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, max_train: int = 6000, max_bytes: int = 64 << 20) -> dict[str, np.ndarray] | None:
    """The network learned from labelled rows outside fold ``held_out``; None without both labels.

    ``max_train`` bounds the ids learned from; half of them are of either label, as far as there are such. Of either label
    texts are taken, in the order of the ids' hashes, until they fill half of ``max_bytes``; the one that does is taken whole.
    """
    marked = labels.filter((bucket_of(F.col("doc_id"), folds) != held_out) & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    marked = marked.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    chosen = [marked.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train // 2) for q in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # max_train rows
    body = F.coalesce("text", F.lit("")).cast("binary")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body")).join(sample, "doc_id").groupBy("doc_id", "quality").agg(
        F.min_by("body", F.xxhash64("body")).alias("body"))
    # max_train rows at most.
    upto = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    taken = texts.withColumn("before", F.coalesce(F.sum(F.octet_length("body").cast("bigint")).over(upto), F.lit(0))).filter(F.col("before") < max_bytes // 2)
    found = taken.select("doc_id", "quality", "body").repartition(1).mapInArrow(_fit, "net binary").collect()
    return dict(np.load(io.BytesIO(found[0].net))) if found else None


def _score(piece: pa.RecordBatch, net: dict | None) -> dict:
    texts = piece.column(2).to_pylist()
    score = np.round(scores(texts, net).astype(np.float64), 6) if net else np.full(len(texts), 0.5)
    return {"doc_id": piece.column(0), "held_out": piece.column(1), "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)}


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, max_train: int = 6000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of whole texts."""
    net = fit(docs, labels, folds, held_out, max_train)
    return map_slices(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (bucket_of(F.col("doc_id"), folds) == held_out).alias("held_out"), "text"),
                      _score, "doc_id bigint, held_out boolean, score double, predicted int", net, size=1 << 20)
