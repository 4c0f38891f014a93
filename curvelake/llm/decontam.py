"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive word positions; positions marked 0 are ignored, so a
substituted word there does not hide a match. Every masked position of the test items and of the
documents is hashed; equal hashes join and give a diagonal (document position minus item
position). Along the diagonal the overlap is verified: the longest segment in which at least
``similarity`` of the words are equal must hold ``min_words`` equal words, or ``similarity`` of all
the words of a shorter item.

Words are runs of letters, digits and marks in lower case. Test items stream in blocks of about
``block_bytes`` of text, each broadcast (that bounds it) and held against all documents; only words
of the block count in a document, so memory does not grow with the corpus.

Null or blank documents and items match nothing; items of fewer than ``min_item`` words are too
short to tell and match nothing. Items without an id take part, under a null ``item_id``. Equal items under one id are one item; repeated documents give
repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import filtered, map_slices, written

#: Every overlap of 12 equal words in at most 15 holds one of the first two seeds, so that at a similarity of 0.8 none
#: is missed; items of fewer than ``LONG`` words need fewer equal words and are filed under the others, of which every
#: permitted overlap of 4 to 11 words holds one.
MASKS = ("111011", "11111", "1111", "1011", "1101")
LONG = 12
MIN_ITEM = 4
WORD = re.compile(r"[^\W_]+")
MULTIPLIERS = np.random.default_rng(77).integers(1, 1 << 62, max(map(len, MASKS)), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: ASCII letters and digits in lower case, everything else a blank: what ``words`` means for plain ASCII texts.
PLAIN = "".join(chr(c).lower() if chr(c).isalnum() else " " for c in range(128))


def words(text: str | None) -> list[str]:
    if not text:
        return []
    return text.translate(PLAIN).split() if text.isascii() else WORD.findall(text.lower())


def _hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """The hash at each start of the mask; zero where a word that counts is unknown."""
    n = len(ids) - len(mask) + 1
    total, known = np.zeros(max(n, 0), np.uint64), np.ones(max(n, 0), bool)
    if n > 0:
        for i, bit in enumerate(mask):
            if bit == "1":
                own = ids[i:i + n]
                total += own * MULTIPLIERS[i]
                known &= own != 0
        total ^= total >> np.uint64(29)
        total[total == 0] = 1
    return np.where(known, total, 0)


class Items:
    """A block of test items: word numbers, and the masked hashes of every position, sorted."""

    def __init__(self, items: list[tuple[int | None, str]], similarity: float, min_words: int):
        self.similarity, self.min_words = similarity, min_words
        split = [(i, w) for i, text in items if len(w := words(text)) >= MIN_ITEM]
        vocabulary = sorted({w for _, own in split for w in own})
        self.places = {w: i for i, w in enumerate(vocabulary, 1)}
        self.values = np.arange(len(vocabulary) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.items = [(i, self.numbers(own)) for i, own in split]
        self.tables = []
        for m, mask in enumerate(MASKS):
            own = [(h, k, q) for k, (_, ids) in enumerate(self.items) if (m < 2) == (len(ids) >= LONG)
                   for q, h in enumerate(_hashes(ids, mask).tolist())]
            if own:
                table = np.array(own, np.uint64)
                table = table[np.argsort(table[:, 0], kind="stable")]
                gate = np.zeros(1 << 20, bool)
                gate[table[:, 0] >> np.uint64(44)] = True
                self.tables.append((mask, table[:, 0].copy(), table[:, 1:].astype(np.int64), gate))

    def numbers(self, own: list[str]) -> np.ndarray:
        """A number for each word of the block's vocabulary, 0 for any other."""
        return self.values[np.fromiter(map(self.places.get, own, repeat(0)), np.int64, len(own))]

    def hits(self, ids: np.ndarray) -> set[tuple[int, int]]:
        """(item, diagonal) of every joined hash."""
        found = set()
        for mask, keys, places, gate in self.tables:
            hashes = _hashes(ids, mask)
            at = np.flatnonzero(gate[hashes >> np.uint64(44)] & (hashes != 0))
            if len(at):
                low, high = np.searchsorted(keys, hashes[at], "left"), np.searchsorted(keys, hashes[at], "right")
                for p, a, b in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
                    found.update((k, p - q) for k, q in places[a:b].tolist())
        return found

    def verify(self, ids: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int, int] | None:
        """(equal words, overlap, document start, item start) of the best segment on the diagonal, if it is enough."""
        own = self.items[item][1]
        start, stop = max(0, -diagonal), min(len(own), len(ids) - diagonal)
        same = own[start:stop] == ids[start + diagonal:stop + diagonal]
        total = np.r_[0.0, np.cumsum(same - self.similarity)]
        # The longest segment: for each end the first start that isn't higher.
        low = np.minimum.accumulate(total)
        first = np.searchsorted(-low, -total - 1e-9)
        end = int(np.argmax(np.arange(len(total)) - first))
        inside = np.flatnonzero(same[first[end]:end]) + first[end]
        if len(inside) < min(self.min_words, int(np.ceil(self.similarity * len(own) - 1e-9))):
            return None
        begin, end = int(inside[0]), int(inside[-1]) + 1
        return len(inside), end - begin, start + diagonal + begin, start + begin

    def search(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """The best verified overlap with each item: (item id, equal words, overlap, document start, item start)."""
        ids = self.numbers(words(text))
        best: dict[int | None, tuple] = {}
        for item, diagonal in sorted(self.hits(ids)):
            if (got := self.verify(ids, item, diagonal)) and got > best.get(self.items[item][0], ()):
                best[self.items[item][0]] = got
        return [(item, *got) for item, got in sorted(best.items(), key=lambda x: (x[0] is None, x[0] or 0))]


def _search(piece: pa.RecordBatch, block) -> dict:
    rows = [(doc, *hit) for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)
            for hit in block.value.search(text)]
    names = ("doc_id", "item_id", "equal_words", "overlap_words", "doc_start", "item_start")
    return {n: [r[i] for r in rows] for i, n in enumerate(names)}


def _blocks(benchmark: DataFrame, similarity: float, min_words: int, block_bytes: int) -> Iterator:
    """The test items in broadcast blocks; items without an id go by their text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = -(-size // block_bytes)
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64(F.coalesce("item_id", F.xxhash64("text"))), F.lit(blocks)) == block).collect()
        held = sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield spark.sparkContext.broadcast(Items(held, similarity, min_words))


def overlaps(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 12, block_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, item_id, equal_words, overlap_words, doc_start, item_start`` (in words): the best overlap of each pair.

    Of the items without an id, the best one of a block stands for all.
    """
    found = None
    for held in _blocks(benchmark, similarity, min_words, block_bytes):
        part = map_slices(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), _search,
                          "doc_id bigint, item_id bigint, equal_words bigint, overlap_words bigint, doc_start bigint, item_start bigint", held)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame(
        [], "doc_id bigint, item_id bigint, equal_words bigint, overlap_words bigint, doc_start bigint, item_start bigint")


def without_overlaps(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 12, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` whose text overlaps with no test item; each row is judged by its own text, whatever its id."""
    for place, held in enumerate(_blocks(benchmark, similarity, min_words, block_bytes)):
        # What one block leaves is written before the next one, so that a task holds one block.
        docs = filtered(written(docs) if place else docs, lambda texts, own: [not own.value.search(t) for t in texts], held)
    return docs
