"""Line deduplication: range-partitioned line hashes in, compressed keep bitmaps out.

Every line of at least ``min_chars`` code points (its key: blanks stripped at both ends, ASCII
letters in lower case) becomes a row of two 64-bit hash halves, document and position. Rows are
range-partitioned and sorted by hash, document (largest first) and position; as the document is
part of the range, a line that a third of all documents hold spreads over many tasks. A task
streams its runs: the first document of a run keeps the line, the others lose it once
``min_docs`` documents are seen. Only the run at a partition's edge may go on elsewhere; its rows
wait for the totals of at most one run per edge, two rows per partition.

Texts are split at line feeds only; a null or empty text is one empty line. Rows without an id
count together as one document, smaller than all others. Repeated rows with the same id are one
document, and each loses the same lines. Other columns pass through untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import map_slices, slices, written
from curvelake.session import growing

#: Stands for a missing id, below every real one.
NO_ID = -(1 << 63)
DROP, WAIT, TOTAL = 0, 1, 2


def _key(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip().lower()  # on bytes: ASCII blanks and letters only
    return key if len(key) >= min_chars and len(key.decode()) >= min_chars else None


def _hashes(piece: pa.RecordBatch, min_chars: int) -> dict:
    docs, prints, positions, counts, digests = [], [], [], [], []
    for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
        whole = (text or "").encode()
        own = whole.split(b"\n")
        keyed = [(i, key) for i, line in enumerate(own) if (key := _key(line, min_chars)) is not None]
        if keyed:
            docs += [doc] * len(keyed)
            prints += [_text_hash(whole)] * len(keyed)
            counts += [len(own)] * len(keyed)
            positions += [i for i, _ in keyed]
            digests += [xxhash.xxh3_128_digest(key) for _, key in keyed]
    halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return {"h1": halves[:, 0], "h2": halves[:, 1], "doc": docs, "print": prints, "pos": positions, "n_lines": counts}


def _text_hash(whole: bytes) -> int:
    value = xxhash.xxh64_intdigest(whole, 42)
    return value - (1 << 64) if value >> 63 else value


def _doc(docs: DataFrame) -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))


class _Run:
    """The run at the end of what has been read: totals, and the rows of its first documents."""

    def __init__(self, rows: np.ndarray, first: bool):
        self.key, self.first, self.docs, self.last, self.top = rows[0, :2], first, 0, None, rows[0, 2]
        self.held: list[np.ndarray] = []

    def add(self, rows: np.ndarray, min_docs: int) -> list[tuple[int, np.ndarray]]:
        doc = rows[:, 2]
        fresh = np.r_[self.last is None or doc[0] != self.last, doc[1:] != doc[:-1]]
        self.docs += int(fresh.sum())
        self.last = doc[-1]
        if self.first:  # may have begun in the partition before
            return [(WAIT, rows)]
        if self.docs < min_docs:
            self.held.append(rows)
            return []
        ready, self.held = [*self.held, rows], []
        return [(DROP, part[part[:, 2] != self.top]) for part in ready]

    def end(self, at_edge: bool) -> list[tuple[int, np.ndarray]]:
        if not (self.first or at_edge):
            return []
        total = np.array([[*self.key, self.top, 0, 0, self.docs]], np.int64)
        return [*((WAIT, part) for part in self.held), (TOTAL, total)]


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("kind", pa.int64()), *((n, pa.int64()) for n in ("h1", "h2", "doc", "print", "pos", "n_lines"))])

    def out(events: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for what, rows in events:
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), what)), *(pa.array(rows[:, i]) for i in range(6))], schema=kind)

    run: _Run | None = None
    for batch in slices(batches, 65_536, 1 << 30):
        rows = np.stack([batch.column(i).to_numpy() for i in range(6)], 1)
        starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)])
        if run is not None and (rows[0, :2] == run.key).all():
            stop = starts[1] if len(starts) > 1 else len(rows)
            yield from out(run.add(rows[:stop], min_docs))
            rows, starts = rows[stop:], starts[1:] - stop
            if not len(rows):
                continue
        if run is not None:
            yield from out(run.end(False))
        elif len(starts) > 1:  # the partition's first run, complete in this batch
            run = _Run(rows, True)
            yield from out(run.add(rows[:starts[1]], min_docs) + run.end(True))
            rows, starts = rows[starts[1]:], starts[1:] - starts[1]
        body, tail = rows[:starts[-1]], rows[starts[-1]:]
        if len(body):  # runs that lie inside the batch
            number = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            fresh = np.r_[True, (body[1:, :3] != body[:-1, :3]).any(1)]
            docs = np.bincount(number[fresh], minlength=len(starts) - 1)
            top = body[starts[:-1], 2]
            yield from out([(DROP, body[(docs[number] >= min_docs) & (body[:, 2] != top[number])])])
        begins_partition = run is None
        run = _Run(tail, begins_partition)
        yield from out(run.add(tail, min_docs))
    if run is not None:
        yield from out(run.end(True))


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc, print, pos, n_lines``: the lines that go, by document (``print`` tells apart texts under one id)."""
    hashed = written(map_slices(docs.select(_doc(docs), "text"), _hashes,
                                "h1 bigint, h2 bigint, doc bigint, print bigint, pos bigint, n_lines bigint", min_chars))
    by = ["h1", "h2", F.desc("doc")]
    events = written(hashed.repartitionByRange(*by).sortWithinPartitions(*by, "pos").mapInArrow(
        lambda it: _stream(it, min_docs), "kind bigint, h1 bigint, h2 bigint, doc bigint, print bigint, pos bigint, n_lines bigint"))
    totals = events.filter(F.col("kind") == TOTAL).groupBy("h1", "h2").agg(F.sum("n_lines").alias("docs"), F.max("doc").alias("top"))
    # Two rows per partition of the range exchange at most.
    late = events.filter(F.col("kind") == WAIT).join(F.broadcast(totals), ["h1", "h2"]).filter(
        (F.col("docs") >= min_docs) & (F.col("doc") != F.col("top")))
    wanted = ["doc", "print", "pos", "n_lines"]
    return events.filter(F.col("kind") == DROP).select(wanted).union(late.select(wanted))


def _bitmaps(piece: pa.RecordBatch) -> dict:
    made = []
    for n, gone in zip(piece.column(2).to_pylist(), piece.column(3), strict=True):
        keep = np.ones(n, bool)
        keep[gone.values.to_numpy()] = False
        made.append(zlib.compress(np.packbits(keep).tobytes()))
    return {"doc": piece.column(0), "print": piece.column(1), "n_lines": piece.column(2),
            "n_dropped": [len(x) for x in piece.column(3)], "keep": made}


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc, print, n_lines, n_dropped, keep`` of documents that lose lines: a zlib-compressed bit per line, 1 for kept."""
    gone = dropped_lines(docs, min_chars, min_docs).groupBy("doc", "print").agg(
        F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("gone"))
    return map_slices(gone, _bitmaps, "doc bigint, print bigint, n_lines bigint, n_dropped bigint, keep binary", rows=4096)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with a column ``__own_keep`` holding the bitmap, null where every line stays."""
    marks = bitmaps.select(F.col("doc").alias("__own_doc"), F.col("print").alias("__own_print"), F.col("keep").alias("__own_keep"))
    return docs.join(growing(marks), (_doc(docs) == F.col("__own_doc")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__own_print")), "left").drop("__own_doc", "__own_print")


def kept_lines(text: str | None, keep: bytes | None) -> tuple[int, int, str | None]:
    """Lines before, lines gone, and the text that stays."""
    if keep is None:
        return (text or "").count("\n") + 1, 0, text
    lines = (text or "").split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:len(lines)]
    return len(lines), int(len(lines) - bits.sum()), "\n".join(line for line, bit in zip(lines, bits.tolist(), strict=True) if bit)


def without_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; a column ``n_chars`` is brought up to date."""
    marked = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    columns = docs.columns
    at, mark = columns.index("text"), len(columns)
    kind = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            own = [piece.column(i) for i in range(mark)]
            text = [kept_lines(t, k)[2] for t, k in zip(piece.column(at).to_pylist(), piece.column(mark).to_pylist(), strict=True)]
            own[at] = pa.array(text, type=own[at].type)
            if "n_chars" in columns:
                n = columns.index("n_chars")
                own[n] = pa.array([None if t is None else len(t) for t in text], type=pa.int64()).cast(own[n].type)
            yield pa.RecordBatch.from_arrays(own, names=columns)

    return marked.select(*columns, "__own_keep").mapInArrow(run, kind)
