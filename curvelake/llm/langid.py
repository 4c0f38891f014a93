"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A three-letter window is
the product of its letters' vectors, each rotated by its place (a word's edge counts as a letter).
A document is the sum of its windows' vectors, a language the sum over its training documents, each
weighted to the same mass. A document goes to the language with the largest cosine.

A null text, or one without a letter, is ``und`` with score 0; so is every text when nothing can be
learned. Empty languages (null) teach nothing. Repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import bucket_of, filtered, map_slices, slices

DIMENSIONS = 512
#: Window vectors held at once, and how many numbers they may have in all.
HELD, CELLS = 32_768, 1 << 25
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=200_000)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([2024, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


class Windows:
    """The three-letter windows of some texts: ``gram`` and ``doc`` per window, and the vectors of the distinct ones."""

    def __init__(self, texts: list[str | None], dimensions: int):
        self.texts, self.dimensions = len(texts), dimensions
        low = [(t or "").lower() for t in texts]
        codes = np.frombuffer(("\0" + "\0".join(low) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(low)), np.fromiter((len(t) + 1 for t in low), np.int64, len(low)))
        letter = _letters()[codes]
        used = np.zeros(0x110000, bool)
        used[codes[letter]] = True
        self.alphabet = np.flatnonzero(used)
        place = np.zeros(0x110000, np.int32)
        place[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        x = place[codes].astype(np.int64)
        self.width = len(self.alphabet) + 1
        middle = np.flatnonzero(x[1:-1]) + 1
        code = (x[middle - 1] * self.width + x[middle]) * self.width + x[middle + 1]
        self.doc = doc[middle - 1]
        if self.width ** 3 <= 1 << 21:
            seen = np.zeros(self.width ** 3, bool)
            seen[code] = True
            self.codes = np.flatnonzero(seen)
            self.gram = (np.cumsum(seen) - 1)[code]
        else:
            self.codes, self.gram = np.unique(code, return_inverse=True)
        self.total = np.bincount(self.doc, minlength=len(low))
        rows = [letter_vector(0, dimensions), *(letter_vector(int(c), dimensions) for c in self.alphabet)]
        self.vectors = [np.roll(np.stack(rows), turn, axis=1) for turn in (2, 1, 0)]
        self.held = self.bind(self.codes) if len(self.codes) <= min(HELD, CELLS // dimensions) else None

    def bind(self, codes: np.ndarray) -> np.ndarray:
        first, rest = np.divmod(codes, self.width * self.width)
        second, third = np.divmod(rest, self.width)
        return (self.vectors[0][first] * self.vectors[1][second] * self.vectors[2][third]).astype(np.float32)

    def bundle(self, gram: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weighted sum of the vectors of distinct windows."""
        if self.held is not None:
            return weight.astype(np.float32) @ self.held[gram]
        out = np.zeros(self.dimensions, np.float32)
        for at in range(0, len(gram), HELD // 4):
            out += weight[at:at + HELD // 4].astype(np.float32) @ self.bind(self.codes[gram[at:at + HELD // 4]])
        return out

    def documents(self) -> Iterator[np.ndarray | None]:
        ends = np.cumsum(self.total)
        for start, end in zip(ends - self.total, ends, strict=True):
            if start == end:
                yield None
            elif self.held is not None:
                count = np.bincount(self.gram[start:end], minlength=len(self.codes))
                own = np.flatnonzero(count)
                yield self.bundle(own, count[own])
            else:
                yield self.bundle(*np.unique(self.gram[start:end], return_counts=True))


def _partial(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """One sum per language for a whole partition."""
    sums: dict[str, np.ndarray] = {}
    for piece in slices(batches, 1024):
        found = Windows(piece.column(1).to_pylist(), dimensions)
        langs = np.array(piece.column(0).to_pylist(), object)
        share = 1.0 / np.maximum(found.total, 1)
        for lang in sorted(set(langs)):
            mine = (langs == lang)[found.doc]
            if mine.any():
                weight = np.bincount(found.gram[mine], share[found.doc[mine]], len(found.codes))
                own = np.flatnonzero(weight)
                sums[lang] = sums.get(lang, 0) + found.bundle(own, weight[own]).astype(np.float64)
    kind = pa.schema([("lang", pa.string()), ("v", pa.list_(pa.float64()))])
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], kind.field("v").type)], schema=kind)


def learn(docs: DataFrame, held_out: Column, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages and their profiles, from rows outside ``held_out``. The result has one row per language."""
    known = docs.filter(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    parts = known.mapInArrow(lambda it: _partial(it, dimensions), "lang string, v array<double>")
    rows = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    names = sorted({r.lang for r in rows})
    profile = np.zeros((len(names), dimensions))
    for r in rows:
        profile[names.index(r.lang), r.i] = r.x
    return names, profile


def _predict(piece: pa.RecordBatch, names: list[str], profile: np.ndarray) -> dict:
    found, langs, scores = Windows(piece.column(2).to_pylist(), profile.shape[1]), [], []
    for vector in found.documents():
        size = 0.0 if vector is None or not names else float(np.linalg.norm(vector))
        cosine = profile @ (vector / size) if size else None
        best = int(np.argmax(cosine)) if size else 0
        langs.append(names[best] if size else UNKNOWN)
        scores.append(round(float(min(1.0, max(0.0, cosine[best]))), 6) if size else 0.0)
    return {"doc_id": piece.column(0), "held_out": piece.column(1), "lang_pred": langs, "score": scores}


def identify(docs: DataFrame, folds: int = 5, dimensions: int = DIMENSIONS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows whose id falls into fold 0 are not learned from."""
    out = bucket_of(F.col("doc_id"), folds) == 0
    names, profile = learn(docs, out, dimensions)
    unit = (profile / np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    return map_slices(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out.alias("held_out"), "text"), _predict,
                      "doc_id bigint, held_out boolean, lang_pred string, score double", names, unit, rows=1024)


def _accepts(texts: list[str | None], names: list[str], profile: np.ndarray, min_score: float, min_windows: int) -> list[bool]:
    found = Windows(texts, profile.shape[1])
    out = []
    for vector, n in zip(found.documents(), found.total, strict=True):
        size = 0.0 if vector is None or not names else float(np.linalg.norm(vector))
        out.append(bool(size) and (n < min_windows or float((profile @ vector).max()) / size >= min_score))
    return out


def accepted(docs: DataFrame, min_score: float, folds: int = 5, dimensions: int = DIMENSIONS, min_windows: int = 1) -> DataFrame:
    """The rows of ``docs`` with a letter and a cosine of at least ``min_score``; texts of fewer than ``min_windows`` windows need only the letter.

    Every row is judged by its own text, whatever its id.
    """
    names, profile = learn(docs, bucket_of(F.col("doc_id"), folds) == 0, dimensions)
    unit = (profile / np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    return filtered(docs, _accepts, names, unit, min_score, min_windows, rows=1024)
