"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming verification, linked groups.

A 64-bit fingerprint is cut into blocks. Two fingerprints with at most ``distance`` differing bits
agree on all but ``distance`` blocks, so they share the key made of the agreeing blocks. More
blocks than ``distance + 1`` give longer keys, which unrelated fingerprints rarely share; every
choice finds every link. Equal fingerprints are one node. A key shared by very many nodes is dealt
in tiles, and each pair of tiles is compared in a task of its own. A task gives a spanning forest
of what it has compared, never all pairs.

Null and blank texts have fingerprint zero and link like any other. Rows without an id take part
but are never a group's name; a group of such rows alone has a null name. Repeated rows and ties
change nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import map_slices, slices, written
from curvelake.llm.links import components
from curvelake.session import growing, spread

SEED = 42
#: The documents of one fingerprint are dealt in parts of so many rows, or of this share of all rows if that is more.
PART_ROWS, LARGEST = 256, 10_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """A bit is 1 if more than half of the shingles' XXH64 values have it; ASCII letters count as lower case."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    width = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    # Bounded pieces, so that a very long text needs no more memory than a short one.
    ones, last = np.zeros(64, np.int64), ends[width - 1:]
    first = (ends - sizes)[:len(last)]
    for at in range(0, len(last), 65_536):
        spans = zip(first[at:at + 65_536].tolist(), last[at:at + 65_536].tolist(), strict=True)
        values = np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in spans]), np.uint8)
        ones += np.add.reduce(np.unpackbits(values).reshape(-1, 64), axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(last)).tobytes(), "big", signed=True)


def _prints(piece: pa.RecordBatch, shingle: int) -> dict:
    return {"doc_id": piece.column(0), "print": [fingerprint(t, shingle) for t in piece.column(1).to_pylist()]}


def _hashed_prints(piece: pa.RecordBatch, shingle: int) -> dict:
    return _prints(piece, shingle) | {"hash": piece.column(2)}


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, print``: the fingerprint of every whole text as a signed 64-bit number."""
    return map_slices(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), _prints, "doc_id bigint, print bigint", shingle)


def block_masks(distance: int, blocks: int) -> list[int]:
    """One mask for every choice of ``blocks - distance`` blocks, as unsigned 64-bit numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [sum(part[i] for i in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(values: np.ndarray, distance: int, other: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the same fingerprints as all pairs within ``distance`` would, each a verified pair.

    With ``other``, pairs between the two arrays; otherwise pairs within ``values``.
    """
    nodes = values if other is None else np.concatenate([values, other])
    label, found = np.arange(len(nodes)), []
    offset = 0 if other is None else len(values)
    against = nodes[offset:]
    for i in range(len(values)):
        start = i + 1 if other is None else 0
        near = np.flatnonzero(np.bitwise_count(against[start:] ^ values[i]) <= distance) + start + offset
        for own in np.unique(label[near]):
            if own != label[i]:
                found.append((int(values[i]), int(nodes[near[label[near] == own][0]])))
                label[label == own] = label[i]
    return found


def _tiles(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and tile pair; the rows of one are compared when they are complete."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[np.ndarray] = []
    current = None

    def compare() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        value, mine = rows[:, 2].astype(np.uint64), rows[:, 3] == 0
        pairs = forest(value, distance) if mine.all() else forest(value[mine], distance, value[~mine])
        if pairs:
            made = np.array(pairs, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], schema=kind)

    for batch in slices(batches, 65_536, 1 << 30):
        rows = np.stack([batch.column(i).to_numpy() for i in range(4)], 1)
        cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(1)) + 1
        for part in np.split(rows, cuts):
            name = (part[0, 0], part[0, 1])
            if name != current:
                if held:
                    yield from compare()
                held, current = [], name
            held.append(part)
    if held:
        yield from compare()


def links(prints: DataFrame, distance: int = 4, blocks: int = 8, tile: int = 2048) -> DataFrame:
    """``a, b``: verified links between distinct fingerprints (column ``print``), enough to join every linked group."""
    keys = F.array(*[
        F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(block_masks(distance, blocks))])
    keyed = prints.select("print").distinct().select("print", F.explode(keys).alias("key"))
    # Most keys belong to one fingerprint; counting first leaves few rows to sort.
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # Spark takes the keys of a fingerprint for one row, so that it would send them through the driver: many times the limit.
    rows = keyed.join(growing(shared), "key").withColumn("tiles", F.ceil(F.col("n") / tile).cast("long")).withColumn(
        "tile", F.pmod(F.xxhash64("print", F.lit(1)), F.col("tiles")))
    # Tile pair (i, j), i <= j, is i * tiles + j; the lower tile has side 0.
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda t: F.struct(
        (F.least(t, F.col("tile")) * F.col("tiles") + F.greatest(t, F.col("tile"))).alias("pair"),
        (F.col("tile") > t).cast("long").alias("side")))
    dealt = rows.select("key", F.explode(pairs).alias("p"), "print").select("key", "p.pair", "print", "p.side")
    dealt = dealt.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return dealt.mapInArrow(lambda it: _tiles(it, distance), "a bigint, b bigint").distinct()


def groups(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 8) -> DataFrame:
    """``doc_id, hash, print, node, component_id`` of every row: its text's hash and fingerprint, the group it is in (the least fingerprint
    there) and the group's name (the smallest id there)."""
    own = docs.selectExpr("cast(doc_id as bigint) doc_id", "text", "xxhash64(coalesce(text, '')) hash")
    prints = written(map_slices(own, _hashed_prints, "doc_id bigint, print bigint, hash bigint", shingle))
    nodes = written(prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    grouped = components(links(spread(nodes, "print"), distance, blocks))
    # The name of a linked group is the smallest id of its members.
    named = nodes.join(growing(grouped), nodes["print"] == grouped["node"])
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    found = named.join(smallest, "component").select(F.col("print").alias("p"), "component", "smallest")
    # Equal fingerprints may be a third of all documents: their join is dealt in parts. At most LARGEST fingerprints have so many
    # documents, so that their list is broadcast at any size.
    many = max(PART_ROWS, (nodes.agg(F.sum("n").alias("n")).first().n or 0) // LARGEST)
    width = (F.floor(F.col("n") / many) + 1).cast("bigint")
    final = nodes.join(growing(found), F.col("print") == F.col("p"), "left").select(
        F.col("print").alias("own"), F.coalesce("component", "print").alias("node"), F.when(F.col("p").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id"),
        F.sequence(F.lit(0).cast("bigint"), width - 1).alias("parts"))
    large = nodes.filter(F.col("n") >= many).select(F.col("print").alias("wide"), width.alias("width"))
    dealt = prints.join(F.broadcast(large), F.col("print") == F.col("wide"), "left").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "hash"), F.coalesce("width", F.lit(1).cast("bigint"))))
    return dealt.join(growing(final.withColumn("own_part", F.explode("parts"))), (F.col("print") == F.col("own")) & (F.col("part") == F.col("own_part"))).select(
        "doc_id", "hash", "print", "node", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 8) -> DataFrame:
    """``doc_id, fingerprint, component_id``: 16 hexadecimal digits and the smallest id reachable over links."""
    return groups(docs, shingle, distance, blocks).select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 8) -> DataFrame:
    """One row of ``docs`` for each group: of its smallest id, and of several texts under that id the one of the least hash.

    Rows go by id and text, so an unlinked text under the id of another one stays; rows without an id stay.
    """
    found = written(groups(docs, shingle, distance, blocks).filter("doc_id is not null"))
    chosen = found.filter("doc_id = component_id").groupBy("node").agg(F.min_by(F.struct("doc_id", "hash"), F.col("hash")).alias("c"), F.count("*").alias("n"))
    chosen = written(chosen.select(F.col("c.doc_id").alias("__own_id"), F.col("c.hash").alias("__own_hash"), "n"))
    hash_ = F.xxhash64(F.coalesce("text", F.lit("")))
    kept = docs.join(growing(chosen), (F.col("doc_id").cast("bigint") == F.col("__own_id")) & (hash_ == F.col("__own_hash")), "left")
    named = kept.filter("doc_id is null or __own_id is not null")
    if chosen.filter("n > 1").isEmpty():
        return named.select(docs.columns)
    # Of repeated rows (equal id and text) one stays.
    again = named.filter("n > 1")
    return named.filter("doc_id is null or n = 1").select(docs.columns).union(again.dropDuplicates(["__own_id", "__own_hash"]).select(docs.columns))
