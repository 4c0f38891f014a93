"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

A word's probability is that of its class, given the words before it, times its share of the
class. Classes group words with like endings that follow like endings; they come from a table of
ending pairs, counted over all training texts. The class softmax is log-linear in hashed features
of the history: the word before (bigram), the word before that (skip), both (trigram). Training
makes one pass over all training texts in ``rounds`` parts. A part is dealt into shards by a hash of
id and text, about ``SHARD`` tokens each; a task follows the gradient over one shard, in the order of
that hash, from the model of the last round, and the shards' models are averaged by weight. So the
model depends on the texts alone, not on how they are stored or on the number of tasks.

Words are counted exactly (under 64-bit hashes) over all training texts. The counts of the
``top`` most frequent words go to every task; a rarer word of a document meets its count in a
join. What is broadcast has a fixed size: the top words, the class table and the model.

Text is split at ASCII blanks with A-Z in lower case, and an end token closes each document, so a
null or empty text has one token. Without training texts no token is known, the base score is 0 and
the model's that of a uniform choice of class. Repeated rows count and score as often as they
stand; rows without an id keep results of their own. Rows equal in id and text share a shard, which
is read as a stream. A very long text is held whole by one task, with some 100 bytes a token. An empty
table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice
from math import ceil, log, log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import bucket_of, slices, written

#: Hashed endings (last three bytes of a word), classes of words, hashed features of the history and their kinds.
ENDINGS, CLASSES, FEATURES, KINDS = 512, 64, 1 << 13, 3
#: Words whose counts every task holds.
TOP = 1 << 17
#: The end token, which no word can be, as it has blanks.
END = b" end "
BATCH, RATE = 2048, 0.4
#: Training tokens of a shard, and how many shards a round has at most: beyond SHARD * SHARDS tokens the shards grow, not
#: the models that cross the network.
SHARD, SHARDS = 1 << 21, 1 << 15


class _Numbers(dict):
    """Words to numbers; a word not seen before gets the next one."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Vocabulary:
    """Numbers for words as they come, with their ``hashes`` and ``endings``. The end token is 0."""

    def __init__(self):
        self.number = _Numbers({END: 0})
        self.hashes = np.array([xxhash.xxh3_64_intdigest(END)], np.uint64).view(np.int64)
        self.endings = np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.number)

    def take(self, words: list[bytes]) -> np.ndarray:
        """The numbers of ``words``; those not seen before get the next ones."""
        before = len(self.number)
        found = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if len(self.number) > before:
            fresh = list(islice(self.number, before, None))
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in fresh], np.uint64).view(np.int64)
            endings = np.array([xxhash.xxh32_intdigest(w[-3:], 9) for w in fresh], np.int64) % (ENDINGS - 1) + 1
            self.hashes, self.endings = np.concatenate([self.hashes, hashes]), np.concatenate([self.endings, endings])
        return found

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens in a row, and how many each text has."""
        words, ends = [], []
        for text in texts:
            if text:
                words += text.encode().lower().split()
            words.append(END)
            ends.append(len(words))
        return self.take(words), np.diff(np.array([0, *ends], np.int64))


def _histories(token: np.ndarray, sizes: np.ndarray, steps: int) -> list[np.ndarray]:
    """For each token the ones 1 .. steps before it in its text; -1 before the start."""
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(token)) - start
    return [np.where(place >= k, np.roll(token, k), -1) for k in range(1, steps + 1)]


def _counts(batches: Iterator[pa.RecordBatch], kept: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Per task: (hash, ending, n) of words, and (-, pair, n) of ending pairs; kept words are flushed beyond a bound."""
    kind = pa.schema([("hash", pa.int64()), ("ending", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])

    def out(held: Vocabulary, counts: np.ndarray) -> pa.RecordBatch:
        n = len(counts)
        return pa.RecordBatch.from_arrays([pa.array(held.hashes), pa.array(held.endings), pa.nulls(n, pa.int64()), pa.array(counts)], schema=kind)

    words, counts = Vocabulary(), np.zeros(1, np.int64)
    pairs = np.zeros(ENDINGS * ENDINGS, np.int64)
    for piece in slices(batches, 2048):
        token, sizes = words.texts(piece.column(0).to_pylist())
        if len(words) > len(counts):
            counts = np.r_[counts, np.zeros(max(len(words), 2 * len(counts)) - len(counts), np.int64)]
        counts += np.bincount(token, minlength=len(counts))
        ending = words.endings
        before = _histories(token, sizes, 1)[0]
        inside = before >= 0
        pairs += np.bincount(ending[before[inside]] * ENDINGS + ending[token[inside]], minlength=len(pairs))
        if len(words) > kept:
            yield out(words, counts[:len(words)])
            words, counts = Vocabulary(), np.zeros(1, np.int64)
    yield out(words, counts[:len(words)])
    at = np.flatnonzero(pairs)
    yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.array(at), pa.array(pairs[at])], schema=kind)


def group_endings(pairs: np.ndarray, seed: int = 3, rounds: int = 20) -> np.ndarray:
    """A class for every ending: endings that stand before and after like endings share one; the end token has class 0."""
    near = np.hstack([pairs, pairs.T]).astype(np.float64)
    mass = pairs.sum(0) + pairs.sum(1)
    # Square roots of shares: Euclidean distance between them compares distributions.
    shape = np.sqrt(near / np.maximum(near.sum(1, keepdims=True), 1))
    used = np.flatnonzero(mass[1:] > 0) + 1
    classes = np.ones(len(pairs), np.int64)
    if len(used):
        rng = np.random.default_rng(seed)
        k = min(CLASSES - 1, len(used))
        first = rng.choice(used, k, replace=False, p=mass[used] / mass[used].sum()) if np.count_nonzero(mass[used]) >= k else used[:k]
        centre = shape[first]
        for _ in range(rounds):
            away = (centre ** 2).sum(1)[None] - 2 * shape[used] @ centre.T
            near_to = away.argmin(1)
            for c in range(k):
                own = used[near_to == c]
                if len(own):
                    centre[c] = np.average(shape[own], axis=0, weights=mass[own])
        classes[used] = near_to + 1
    classes[0] = 0
    return classes


@dataclass
class Model:
    """Class of each ending, logarithms of the classes' shares, of their mass (base 10), and the feature weights."""

    classes: np.ndarray
    base: np.ndarray
    mass: np.ndarray
    weight: np.ndarray

    def features(self, words: Vocabulary, token: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """[KINDS, tokens] rows of ``weight`` for the bigram, the skip and the trigram feature of each token."""
        hashes = np.r_[words.hashes, 1].view(np.uint64)  # the last is a text's start
        one, two = _histories(token, sizes, 2)
        row = lambda x, m: (x * np.uint64(m) >> np.uint64(51)).astype(np.int64)  # noqa: E731  13 bits
        both = (hashes * np.uint64(0x9E3779B97F4A7C15))[one] ^ (hashes * np.uint64(0xC2B2AE3D27D4EB4F))[two]
        return np.stack([row(hashes, 0x9FB21C651E98DF25)[one], row(hashes, 0xD6E8FEB86659FD93)[two] + FEATURES, row(both, 0xA0761D6478BD642F) + 2 * FEATURES])

    def logits(self, feature: np.ndarray) -> np.ndarray:
        """[tokens, classes], less their largest."""
        out = self.weight[feature[0]] + self.base
        for rows in feature[1:]:
            out += self.weight[rows]
        out -= out.max(1, keepdims=True)
        return out

    def log_probability(self, feature: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithm of the target class's probability."""
        out = np.empty(len(target))
        for at in range(0, len(target), 16_384):
            part = slice(at, at + 16_384)
            logit = self.logits(feature[:, part])
            out[part] = logit[np.arange(len(logit)), target[part]] - np.log(np.exp(logit).sum(1))
        return out


def _sums(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over runs of rows that begin at ``first``. Most runs are short, so their k-th rows are added at once."""
    total = values[first]
    left = np.flatnonzero(sizes > 1)
    for k in range(1, 8):
        if not len(left):
            return total
        total[left] += values[first[left] + k]
        left = left[sizes[left] > k + 1]
    for i in left:
        total[i] += values[first[i] + 8:first[i] + sizes[i]].sum(0)
    return total


def _follow(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """Gradient steps over one shard's texts; gives the changed weights, each with the tokens that it has seen."""
    start: Model = held.value
    model = replace(start, weight=start.weight.copy())
    moved = np.full((KINDS * FEATURES, 1), 1.0, np.float32)  # squared gradients so far, per feature
    seen = np.zeros(KINDS * FEATURES)
    words = Vocabulary()

    def step(own: np.ndarray, goal: np.ndarray) -> None:
        logit = model.logits(own)
        np.exp(logit, out=logit)
        logit /= logit.sum(1, keepdims=True)
        logit[np.arange(len(goal)), goal] -= 1  # the gradient of each token's loss
        flat = own.reshape(-1).astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        sizes = np.diff(np.r_[first, len(ranked)])
        total = _sums(logit[order % len(goal)], first, sizes)
        rows = ranked[first].astype(np.int64)
        seen[rows] += sizes
        moved[rows] += np.einsum("ij,ij->i", total, total)[:, None]
        total *= np.float32(RATE) / np.sqrt(moved[rows])
        model.weight[rows] -= total

    # Steps are cut from the shard's run of tokens, wherever its Arrow batches end.
    rest, goals = np.zeros((KINDS, 0), np.int64), np.zeros(0, np.int64)
    for piece in slices(batches, 2048):
        if len(words) > 1 << 20:
            words = Vocabulary()
        token, sizes = words.texts(piece.column(0).to_pylist())
        feature = np.hstack([rest, model.features(words, token, sizes)])
        target = np.r_[goals, model.classes[words.endings[token]]]
        whole = len(target) - len(target) % BATCH
        for at in range(0, whole, BATCH):
            step(feature[:, at:at + BATCH], target[at:at + BATCH])
        rest, goals = feature[:, whole:], target[whole:]
    if len(goals):
        step(rest, goals)
    at = np.flatnonzero(seen)
    weight = (model.weight[at] * seen[at, None]).astype(np.float32)
    names = ["feature", "seen", *(f"w{c}" for c in range(CLASSES))]
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at]), *(pa.array(np.ascontiguousarray(weight[:, c])) for c in range(CLASSES))], names=names)


def _score(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """Per document: tokens, and what the model and the top words give; each rarer word as (row, hash, n)."""
    model, top_hash, top_count = held.value
    order = np.argsort(top_hash)
    top_hash, top_count = top_hash[order], top_count[order]
    kind = pa.schema([("row", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                      ("tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("classes", pa.float64())])
    words = Vocabulary()
    count = np.zeros(0)
    for piece in slices(batches, 1024):
        if len(words) > 1 << 19:
            words, count = Vocabulary(), np.zeros(0)
        token, sizes = words.texts(piece.column(3).to_pylist())
        fresh = words.hashes[len(count):]
        if len(top_hash) and len(fresh):
            place = np.minimum(np.searchsorted(top_hash, fresh), len(top_hash) - 1)
            fresh = np.where(top_hash[place] == fresh, top_count[place], 0)
        count = np.r_[count, fresh if len(top_hash) else np.zeros(len(fresh))]
        own = np.repeat(np.arange(len(sizes)), sizes)
        target = model.classes[words.endings[token]]
        chosen = model.log_probability(model.features(words, token, sizes), target) / log(10) - model.mass[target]
        is_top = count[token] > 0
        logs = np.bincount(own[is_top], np.log10(count[token[is_top]] + 0.1), len(sizes))
        rows = np.asarray(piece.column(0))
        yield pa.RecordBatch.from_arrays([
            piece.column(0), pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.int64()), piece.column(1), piece.column(2), pa.array(sizes),
            pa.array(np.bincount(own[is_top], minlength=len(sizes)).astype(np.int64)), pa.array(logs), pa.array(np.bincount(own, chosen, len(sizes)))], schema=kind)
        rare, n = np.unique(own[~is_top] * len(words) + token[~is_top], return_counts=True)
        size = len(rare)
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[rare // len(words)]), pa.array(words.hashes[rare % len(words)]), pa.array(n.astype(np.int64)),
            *(pa.nulls(size, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], schema=kind)


def vocabulary(texts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``hash, ending, c`` of every distinct training word, and the table of ending pairs (of a fixed size)."""
    found = written(texts.mapInArrow(_counts, "hash bigint, ending bigint, pair bigint, n bigint"))
    words = written(found.filter("pair is null and n > 0").groupBy("hash").agg(F.min("ending").alias("ending"), F.sum("n").alias("c")))
    pairs = np.zeros(ENDINGS * ENDINGS)
    counted = found.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    return words, pairs.reshape(ENDINGS, ENDINGS)


def train(learned: DataFrame, model: Model, rounds: int = 2, shards: int = 1) -> Model:
    """Average the models of the ``shards`` of every round over ``learned`` (``doc_id, text``)."""
    schema = ", ".join(["feature bigint", "seen double", *(f"w{c} float" for c in range(CLASSES))])
    keyed = learned.select("text", F.xxhash64("doc_id", "text").alias("key"))
    for part in range(rounds):
        held = learned.sparkSession.sparkContext.broadcast(model)  # a fixed size
        own = keyed.filter(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(rounds)) == part)
        dealt = own.repartitionById(shards, F.pmod("key", F.lit(shards)).cast("int")).sortWithinPartitions("key").select("text")
        sums = dealt.mapInArrow(lambda it, held=held: _follow(it, held), schema).groupBy("feature").agg(
            F.sum("seen").alias("seen"), *[F.sum(f"w{c}").alias(f"w{c}") for c in range(CLASSES)]).toArrow()
        weight = model.weight.copy()
        total = np.stack([sums[f"w{c}"].to_numpy() for c in range(CLASSES)], 1) if sums.num_rows else np.zeros((0, CLASSES))
        weight[sums["feature"].to_numpy()] = (total / sums["seen"].to_numpy()[:, None]).astype(np.float32)
        model = replace(model, weight=weight)
        held.unpersist()
    return model


@dataclass
class Fitted:
    """The model, the table of word counts, tokens and distinct words in all, and the most frequent words."""

    model: Model
    words: DataFrame
    tokens: int
    distinct: int
    top_hash: np.ndarray
    top_count: np.ndarray


def fit(learned: DataFrame, rounds: int = 2, top: int = TOP, shard: int = SHARD) -> Fitted:
    """Count, group and train over all texts of ``learned`` (``doc_id, text``)."""
    words, pairs = vocabulary(learned.select("text"))
    size = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    classes = group_endings(pairs)
    # Tokens and distinct words of every class; an unknown word of the class has a share too.
    tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in words.groupBy("ending").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # ENDINGS rows at most
        tokens[classes[r.ending]] += r.n
        distinct[classes[r.ending]] += r.v
    base = np.log((tokens + 0.1) / (tokens + 0.1).sum())
    model = Model(classes, base.astype(np.float32), np.log10(tokens + 0.1 * (distinct + 1)), np.zeros((KINDS * FEATURES, CLASSES), np.float32))
    model = train(learned, model, rounds, min(SHARDS, max(1, ceil(int(size.n) / rounds / shard))))
    frequent = words.orderBy(F.desc("c"), "hash").limit(top).select("hash", "c").toArrow()
    return Fitted(model, words, int(size.n), int(size.v), frequent["hash"].to_numpy(), frequent["c"].to_numpy().astype(np.float64))


def scores(docs: DataFrame, folds: int = 10, rounds: int = 2, top: int = TOP) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; ids in fold 0 are not learned from."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (bucket_of(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    return score_with(own, fit(own.filter("not held_out"), rounds, top))


def score_with(own: DataFrame, fitted: Fitted) -> DataFrame:
    """Scores of ``doc_id, held_out, text`` under a fitted model."""
    held = own.sparkSession.sparkContext.broadcast((fitted.model, fitted.top_hash, fitted.top_count))
    parts = written(own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        lambda it: _score(it, held), "row bigint, hash bigint, n bigint, doc_id bigint, held_out boolean, tokens bigint, known bigint, logs double, classes double"))
    none = lambda kind: F.lit(None).cast(kind)
    rare = parts.filter("hash is not null").select("row", "hash", "n").join(fitted.words.select("hash", "c"), "hash", "left").select(
        "row", none("bigint").alias("doc_id"), none("boolean").alias("held_out"), F.lit(0).cast("bigint").alias("tokens"),
        F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"),
        (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("logs"), F.lit(0.0).alias("classes"))
    whole = parts.filter("hash is null").select(rare.columns).union(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
        F.sum("logs").alias("logs"), F.sum("classes").alias("classes"))
    share = log10(fitted.tokens + 0.1 * (fitted.distinct + 1))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(fitted.tokens).cast("bigint").alias("train_tokens"),
                        (F.col("logs") - F.col("n_tokens") * share).alias("base_score"), (F.col("logs") + F.col("classes")).alias("score"))
