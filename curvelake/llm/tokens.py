"""Token counts of a byte-level pair vocabulary by rank-synchronous merging of ragged arrays.

Pre-tokens of a batch are laid out in one flat symbol array. Every round finds each sequence's
pair of lowest rank and merges all its occurrences in all sequences at once; a sequence is done
when no neighbouring pair has a rank. As each merge makes a symbol of its own, whose merges rank
behind it, this gives the same symbols as merging one pair after another.

Null and empty texts have 0 bytes and 0 tokens. A special string inside a text is one token, as
the library counts it by default. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from curvelake.llm.common import map_slices

#: How the public vocabulary splits text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose counts a worker keeps; beyond that it starts anew, which costs time only.
CACHE = 400_000


class Merges:
    """Ranks of symbol pairs. Symbols 0-255 are bytes; the merge of rank r makes symbol 256 + r."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.splitter = regex.compile(PATTERN)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # Byte-level vocabularies write printable bytes as themselves and the rest, in order, from U+0100 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        written = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        ids, left, right = dict(written), [], []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left.append(ids[a])
            right.append(ids[b])
            ids[a + b] = 256 + rank
        keys = np.array(left, np.int64) * len(ids) + np.array(right, np.int64)
        order = np.argsort(keys)
        self.symbols, self.keys, self.ranks = len(ids), keys[order], order.astype(np.int64)
        self.none = len(keys)
        self.known: dict[str, int] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.symbols + b
        at = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def lengths(self, sequences: list[bytes]) -> np.ndarray:
        """How many symbols are left of each non-empty byte sequence."""
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        symbol = np.frombuffer(b"".join(sequences), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(sequences)), sizes)
        out = sizes.copy()
        while len(symbol) > 1:
            rank = np.full(len(symbol), self.none, np.int64)
            inside = owner[1:] == owner[:-1]
            rank[:-1][inside] = self.rank(symbol[:-1][inside], symbol[1:][inside])
            starts = np.flatnonzero(np.r_[True, ~inside])
            lowest = np.minimum.reduceat(rank, starts)
            live = lowest < self.none
            if not live.any():
                break
            each = np.diff(np.r_[starts, len(symbol)])
            busy = np.repeat(live, each)
            hit = (rank == np.repeat(lowest, each)) & busy
            # Of overlapping occurrences (a run of hits) the first, third, ... merge.
            place = np.arange(len(symbol))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, -1))
            hit &= (place - run) % 2 == 0
            symbol = np.where(hit, 256 + rank, symbol)
            keep = busy & ~np.r_[False, hit[:-1]]  # finished sequences leave the arrays
            out -= np.bincount(owner[np.flatnonzero(hit)], minlength=len(out))
            symbol, owner = symbol[keep], owner[keep]
        return out

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the pre-tokens new to this worker are merged together."""
        if len(self.known) > CACHE:
            self.known.clear()
        extra = [len(self.marks.findall(t)) if self.marks else 0 for t in texts]
        pieces = [[x for part in (self.marks.split(t) if n else [t]) for x in self.splitter.findall(part)] for t, n in zip(texts, extra, strict=True)]
        fresh = list(set().union(*pieces).difference(self.known))
        for start in range(0, len(fresh), 20_000):
            part = fresh[start:start + 20_000]
            self.known.update(zip(part, self.lengths([x.encode() for x in part]).tolist(), strict=True))
        return [sum(map(self.known.__getitem__, own)) + n for own, n in zip(pieces, extra, strict=True)]


@lru_cache(maxsize=1)
def merges(path: str) -> Merges:
    return Merges(path)


def _count(piece: pa.RecordBatch, path: str, limit: int) -> dict:
    texts = [t or "" for t in piece.column(1).to_pylist()]
    tokens = merges(path).counts(texts)
    return {"doc_id": piece.column(0), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of whole texts; ``path`` names the vocabulary file on every machine."""
    return map_slices(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), _count,
                      "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", path, limit, size=2 << 20)
