"""Hard negatives by slot-decomposed selection.

Vectors become whole numbers ``floor(scale * x)``; a score is the exact inner product of two of them. Higher scores
come first, ties by smaller id. For every anchor, its best rows of the same label are its positives. A positive of
score ``P`` asks for the best rows of other labels with scores in ``[low * P / high, P]``; these windows overlap.

The positives' scores are upper limits that cut the scores into disjoint slots. Every row falls into one slot of an
anchor at most, and the best ``k`` of a slot are kept, first inside a block of rows, then over all blocks. Merging
the slots from the lowest upwards gives the best ``k`` below every limit, so each window is answered by one merged
list, cut at the window's lower end: rows that a slot has left out stand behind ``k`` better ones of the same slot.

All rows lie in blocks of bounded size; the anchors are read past each block in small pieces. A task holds one block
and one piece, and gives at most ``k`` rows per anchor and slot. The work is anchors times rows; what crosses the
network is the rows, the anchors once for each block, and the lists.

Rows without id, label or vector, or with a null or non-finite entry, take no part. Rows that share an id count as
one, the least by label, then vector. Shorter vectors are padded with zeros. Scores beyond 64 bits are held at the
ends of that range. Equal vectors and equal scores are ordered by id. An anchor without positives, or whose windows
are empty, gives no rows; so does an empty table. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import written
from curvelake.session import spread

#: Rows of a block, and anchors that are scored against it at a time.
BLOCK, PIECE = 65_536, 64
ENDS = (-(1 << 63), (1 << 63) - 1)


def whole_numbers(rows: DataFrame, vector: str, label: Column, scale: int) -> DataFrame:
    """``vec_id, label, x``: one row for each id, ``x`` the floors as doubles."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    most = F.lit(float(np.finfo(np.float64).max))

    def whole(c: Column) -> Column:
        # Spark's floor gives a long, which a huge entry does not fit; such entries are whole already.
        wide = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(wide) < 2.0**52, F.floor(wide).cast("double")).otherwise(F.least(F.greatest(wide, -most), most))

    clean = rows.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), F.transform(vector, whole).alias("x")).filter("label is not null")
    return clean.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("own")).select("vec_id", "own.label", "own.x")


def matrix(lists: pa.Array) -> np.ndarray:
    """A list column as rows of doubles, shorter ones padded with zeros."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wide = int(sizes.max(initial=0))
    if (sizes == wide).all():
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide))
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, held at the ends of 64 bits."""
    wide = min(left.shape[1], right.shape[1])
    left, right = left[:, :wide], right[:, :wide]
    bound = wide * np.abs(left).max(initial=0) * np.abs(right).max(initial=0)
    if bound < 2.0**24:
        return left.astype(np.float32) @ right.astype(np.float32).T
    if bound < 2.0**53:
        return left @ right.T
    as_ints = np.frompyfunc(int, 1, 1)
    exact = as_ints(left).astype(object) @ as_ints(right).astype(object).T
    return np.clip(exact, *ENDS).astype(np.int64)


def firsts(groups: tuple[np.ndarray, ...], order: tuple[np.ndarray, ...], k: int) -> np.ndarray:
    """Positions of the first ``k`` by ``order`` in each group."""
    sort = np.lexsort((*order[::-1], *groups[::-1]))
    if not len(sort):
        return sort
    new = np.zeros(len(sort), bool)
    for g in groups:
        new[1:] |= g[sort][1:] != g[sort][:-1]
    starts = np.flatnonzero(np.r_[True, new[1:]])
    place = np.arange(len(sort)) - np.repeat(starts, np.diff(np.r_[starts, len(sort)]))
    return sort[place < k]


class Block:
    """Rows of a block by label, then id."""

    def __init__(self, pieces: list[pa.RecordBatch]):
        held = pa.Table.from_batches(pieces).combine_chunks()
        ids, labels = held["vec_id"].to_numpy(), held["label"].to_numpy()
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        self.rows = matrix(held["x"].chunk(0))[order]

    def positives(self, anchors: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Anchor, row and score of the best ``k`` other rows of the same label here."""
        own, ids, vectors = anchors["label"].to_numpy(), anchors["vec_id"].to_numpy(), matrix(anchors["x"])
        for label in np.unique(own):
            first, last = np.searchsorted(self.labels, [label, label + 1]) if label < ENDS[1] else (np.searchsorted(self.labels, label), len(self.labels))
            if first == last:
                continue
            who = np.flatnonzero(own == label)
            scores = products(vectors[who], self.rows[first:last])
            # One more than asked for, as the anchor itself may be among them.
            short = max(0, scores.shape[1] - k - 1)
            row, col = np.nonzero(scores >= np.partition(scores, short, axis=1)[:, short:short + 1])
            score, near = scores[row, col].astype(np.int64), self.ids[first:last][col]
            other = near != ids[who][row]
            row, score, near = row[other], score[other], near[other]
            take = firsts((row,), (-score.clip(ENDS[0] + 1), near), k)
            yield ids[who][row[take]], near[take], score[take]

    def negatives(self, anchors: pa.RecordBatch, k: int, low: int, high: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Anchor, slot, row and score of the best ``k`` rows of other labels in each slot here."""
        own, ids = anchors["label"].to_numpy(), anchors["vec_id"].to_numpy()
        limits = [sorted(x, reverse=True) for x in anchors["limits"].to_pylist()]
        floor = np.array([lowest(x[-1], low, high) for x in limits], np.int64)
        most = max(map(len, limits))
        steps = np.array([x + [ENDS[0]] * (most - len(x)) for x in limits], np.int64)
        scores = products(matrix(anchors["x"]), self.rows)
        row, col = np.nonzero((scores >= floor[:, None]) & (scores <= steps[:, :1]))
        apart = self.labels[col] != own[row]
        row, col = row[apart], col[apart]
        score = scores[row, col].astype(np.int64)
        slot = (steps[row] >= score[:, None]).sum(1) - 1
        take = firsts((row, slot), (-score, self.ids[col]), k)
        yield ids[row[take]], slot[take], self.ids[col[take]], score[take]


def lowest(limit: int, low: int, high: int) -> int:
    """The least whole score ``n`` with ``low * limit <= high * n``."""
    return -(-low * limit // high)


def past_blocks(rows: DataFrame, anchors: DataFrame, blocks: int, work, kind: pa.Schema, spark_kind: str) -> DataFrame:
    """Every anchor meets every block: ``work(block, piece of anchors)`` gives columns."""
    limits = "limits" if "limits" in anchors.columns else "cast(null as array<bigint>) limits"
    here = rows.selectExpr("pmod(xxhash64(vec_id), cast(%d as bigint)) block" % blocks, "0 side", "vec_id", "label", "x", "cast(null as array<bigint>) limits")
    there = anchors.selectExpr("explode(sequence(cast(0 as bigint), cast(%d as bigint))) block" % (blocks - 1), "1 side", "vec_id", "label", "x", limits)
    dealt = spread(here.unionByName(there), "block").sortWithinPartitions("block", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, block = None, [], None
        for batch in batches:
            marks = np.stack([batch["block"].to_numpy(), batch["side"].to_numpy()], 1)
            cuts = np.r_[0, np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1, len(marks)]
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if start == end:
                    continue
                if marks[start, 0] != name:
                    name, held, block = marks[start, 0], [], None
                part = batch.slice(start, end - start)
                if marks[start, 1] == 0:
                    held.append(part)
                    continue
                if block is None and held:
                    block, held = Block(held), []
                for at in range(0, part.num_rows if block else 0, PIECE):
                    for columns in work(block, part.slice(at, PIECE)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, kind, strict=True)], schema=kind)

    return dealt.mapInArrow(run, spark_kind)


def best(df: DataFrame, groups: list[str], k: int, score: str, name: str) -> DataFrame:
    place = Window.partitionBy(*groups).orderBy(F.desc(score), name)
    return df.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def suffix_merges(slots: list[list[tuple[int, int]]], k: int) -> list[list[tuple[int, int]]]:
    """For every slot, the best ``k`` of it and all lower ones; ``slots`` are sorted and stand from the highest down."""
    merged: list[list[tuple[int, int]]] = [[]] * len(slots)
    below: list[tuple[int, int]] = []
    for at in range(len(slots) - 1, -1, -1):
        below = (slots[at] + below)[:k]  # every score of a slot is above those of the lower ones
        merged[at] = below
    return merged


def windows(positives: list[tuple[int, int]], found: list[tuple[int, int, int]], k: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``positive, rank, negative, positive score, negative score`` of one anchor's windows."""
    limits = sorted({score for score, _ in positives if score >= 0}, reverse=True)
    slots: list[list[tuple[int, int]]] = [[] for _ in limits]
    for slot, score, name in sorted(found, key=lambda x: (x[0], -x[1], x[2])):
        slots[slot].append((score, name))
    merged = suffix_merges(slots, k)
    for score, positive in positives:
        if score >= 0:
            inside = [x for x in merged[limits.index(score)] if x[0] >= lowest(score, low, high)]
            for rank, (other, name) in enumerate(inside, 1):
                yield positive, rank, name, score, other


def hard_negatives(rows: DataFrame, anchors: Column, label: Column | None = None, vector: str = "embedding", positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` tells by ``vec_id`` which rows are anchors, ``label`` is the label of a row (its column by default), and a
    negative's score lies between ``low / high`` of its positive's and the whole of it (``0 < low <= high``).
    """
    all_rows = written(whole_numbers(rows, vector, F.col("label") if label is None else label, scale))
    spark = rows.sparkSession
    blocks = max(2 * spark.sparkContext.defaultParallelism, -(-all_rows.count() // block))
    asked = all_rows.filter(anchors)

    kind = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())])
    near = past_blocks(all_rows, asked, blocks, lambda b, part: b.positives(part, positives), kind, "anchor_id bigint, positive_id bigint, score bigint")
    chosen = best(near, ["anchor_id"], positives, "score", "positive_id").groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("down"), "positive_id", "score"))).alias("positives"))
    chosen = written(chosen.select("anchor_id", "positives", F.array_distinct(F.filter("positives.score", lambda s: s >= 0)).alias("limits")).filter(
        F.size("limits") > 0))

    limited = asked.join(chosen, asked["vec_id"] == chosen["anchor_id"]).select("vec_id", "label", "x", "limits")
    kind = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("negative_id", pa.int64()), ("score", pa.int64())])
    in_slots = past_blocks(all_rows, limited, blocks, lambda b, part: b.negatives(part, negatives, low, high), kind,
                           "anchor_id bigint, slot int, negative_id bigint, score bigint")
    lists = best(in_slots, ["anchor_id", "slot"], negatives, "score", "negative_id").groupBy("anchor_id").agg(
        F.collect_list(F.struct("slot", "score", "negative_id")).alias("found"))
    out = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                     ("positive_score", pa.int64()), ("negative_score", pa.int64())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for anchor, own, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                listed = [(p["score"], p["positive_id"]) for p in own]
                made += [(anchor, *row) for row in windows(listed, [(f["slot"], f["score"], f["negative_id"]) for f in found], negatives, low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True) if made else [[]] * 6, out, strict=True)], schema=out)

    return chosen.select("anchor_id", "positives").join(lists, "anchor_id").select("anchor_id", "positives", "found").mapInArrow(
        answer, "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
