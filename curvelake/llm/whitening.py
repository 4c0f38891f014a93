"""Whitening of vectors by their weighted covariance.

An entry ``c`` becomes the whole number ``x = floor(scale * c) + shift``. Equal x-vectors are grouped; a group's size, or
one, is its weight in the fit. Sums are exact, and ``x - S / n`` comes from the exact ``n * x - S``, so nothing
is lost before products are taken. Every task multiplies its weighted centred rows once (``dims x dims`` numbers per
task cross the network); eigenvectors of the sum are found on the driver. Each distinct vector is whitened once, and the rows
get theirs by a join on the vector. Every row has a part number besides; a vector that a third of the rows share meets
them part by part.

Rows whose vector is null or holds null or non-finite entries are dropped. Shorter vectors are padded with entries of 0.
``floor(scale * c)`` is held between -2^53 and 2^53. A deviation beyond 64 bits is null. A component without variance (its
eigenvalue is rounding of the largest) has null ``whitened`` and an ``explained`` of 0, and plays no part in
``identity_error``, which is null if no component varies. Every row counts, repeated ones and ones without an id too. An empty
table, or one without a usable vector, gives no rows. Other columns are ignored, whatever their names.

The driver holds ``dims x dims`` numbers: meant for up to some two thousand dimensions, at any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import written

#: Rows of one vector that may meet in one part of the join.
PART = 65_536
#: Whole numbers of a key are 16 bits wide where they fit, else 64.
NARROW, WIDE = np.dtype("<i2"), np.dtype("<i8")
#: Sums are carried in two numbers, above and below this many bits, so that they stay exact.
BITS = 20


def keys(lists: pa.Array, dims: int, scale: float) -> tuple[np.ndarray, list[bytes]]:
    """Which rows are usable, and for those the packed ``floor(scale * c)`` of ``dims`` entries."""
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    flat = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    own = np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))
    usable = sizes >= 0
    usable[own[~np.isfinite(flat)]] = False
    held = usable[own]
    out = np.zeros((len(sizes), dims))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0), np.maximum(sizes, 0))
    with np.errstate(over="ignore"):
        out[own[held], place[held]] = np.floor(scale * flat[held]).clip(-2.0**53, 2.0**53)
    rows = out[usable].astype(np.int64)
    narrow = (np.abs(rows).max(axis=1, initial=0) < 1 << 15).tolist()
    return usable, [row.astype(NARROW if n else WIDE).tobytes() for row, n in zip(rows, narrow, strict=True)]


def unpacked(packed: list[bytes], dims: int) -> np.ndarray:
    if all(len(p) == NARROW.itemsize * dims for p in packed):
        return np.frombuffer(b"".join(packed), NARROW).reshape(len(packed), dims).astype(np.int64)
    return np.stack([np.frombuffer(p, NARROW if len(p) == NARROW.itemsize * dims else WIDE).astype(np.int64) for p in packed])


def keyed(rows: DataFrame, vector: str, dims: int, scale: float, parts: int) -> DataFrame:
    """``vec_id, key, part`` of every usable row; parts are dealt in turn."""
    kind = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                usable, packed = keys(piece.column(1), dims, scale)
                part = (np.arange(len(packed)) + done) % parts
                done += len(packed)
                yield pa.RecordBatch.from_arrays([piece.column(0).filter(pa.array(usable)), pa.array(packed, pa.binary()), pa.array(part, pa.int64())], schema=kind)

    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).mapInArrow(
        run, "vec_id bigint, key binary, part bigint")


def spans(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole numbers and weights, in pieces of some 8 MB."""
    step = max(1, (1 << 20) // max(1, dims))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            piece = batch.slice(at, step)
            yield unpacked(piece.column(0).to_pylist(), dims), piece.column(1).to_numpy()


def centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, exact: 64-bit numbers where they fit, Python's otherwise."""
    if int(np.abs(rows).max(initial=0)) * n < 1 << 61:
        return rows * n - sums.astype(np.int64)
    return rows.astype(object) * n - sums


def deviations(apart: np.ndarray) -> list[int | None]:
    most = max(int(abs(apart.max(initial=0))), int(abs(apart.min(initial=0))))
    if most * most * max(1, apart.shape[1]) < 1 << 63 and apart.dtype == np.int64:
        return (apart * apart).sum(1).tolist()
    whole = apart.astype(object)
    return [s if s < 1 << 63 else None for s in map(int, (whole * whole).sum(1))]


def _sums(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    kind = pa.schema([("dim", pa.int32()), ("above", pa.int64()), ("below", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, below, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for rows, weight in spans(batches, dims):
            above += weight @ (rows >> BITS)
            below += weight @ (rows & (1 << BITS) - 1)
            n += int(weight.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(above), pa.array(below), pa.array(np.full(dims, n), pa.int64())], schema=kind)

    found = vectors.mapInArrow(run, "dim int, above bigint, below bigint, n bigint").groupBy("dim").agg(
        *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("above", "below", "n")]).orderBy("dim").collect()
    return int(found[0]["n"]), np.array([(int(r["above"]) << BITS) + int(r["below"]) for r in found], object)


def _moments(vectors: DataFrame, wide: int, made) -> np.ndarray:
    """Sums over all tasks of the ``wide x wide`` products that ``made(batches)`` adds up in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = made(batches)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(wide), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    found = vectors.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((wide, wide))
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
    return out


def whitened(rows: DataFrame, vector: str = "embedding", scale: float = 64.0, components: int = 32, weights: str = "count") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    ``weights`` is ``count``, where every row counts in the fit, or ``one``, where every distinct vector does. ``x`` has
    no shift here, as nothing that is returned depends on it. Eigenvectors point to where their largest entry is positive.
    """
    spark = rows.sparkSession
    usable = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    size = rows.filter(usable).agg(F.max(F.size(vector)).alias("dims"), F.count("*").alias("n")).first()
    dims, kind = size["dims"] or 0, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not dims:
        return spark.createDataFrame([], kind)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size["n"] // PART + 1)
    dealt = written(keyed(rows, vector, dims, scale, parts))
    weight = F.sum("n") if weights == "count" else F.lit(1).cast("bigint")
    distinct = written(dealt.groupBy("key", "part").agg(F.count("*").alias("n")).groupBy("key").agg(weight.alias("weight"), F.collect_list("part").alias("parts")))
    fit = distinct.select("key", "weight")
    n, sums = _sums(fit, dims)

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((dims, dims))
        for own, w in spans(batches, dims):
            apart = centred(own, n, sums).astype(np.float64) / n
            total += (apart * w[:, None]).T @ apart
        return total

    covariance = _moments(fit, dims, products) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    trace, wide = float(np.trace(covariance)), len(values)
    varies = values > max(values[0], 0) * dims * 1e-14
    scaled = axes / np.sqrt(np.where(varies, values, 1))

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                apart = centred(unpacked(piece.column(0).to_pylist(), dims), n, sums)
                turned = apart.astype(np.float64) / n @ scaled
                flat = pa.array(turned.ravel(), mask=np.tile(~varies, len(turned)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(turned) + 1) * wide, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), piece.column(2), pa.array(deviations(apart), pa.int64()), lists],
                                                 names=["key", "weight", "parts", "deviation", "white"])

    made = written(distinct.select("key", "weight", "parts").mapInArrow(white, "key binary, weight bigint, parts array<bigint>, deviation bigint, white array<double>"))
    inside = np.flatnonzero(varies)

    def squares(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        # The last row and column carry the sums.
        total = np.zeros((len(inside) + 1, len(inside) + 1))
        for batch in batches:
            own = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, wide)[:, inside]
            own = np.c_[own, np.ones(len(own))]
            total += (own * batch.column(1).to_numpy()[:, None]).T @ own
        return total

    moments = _moments(made.select("white", "weight"), len(inside) + 1, squares) / n
    error = float(np.abs(moments[:-1, :-1] - np.outer(moments[-1, :-1], moments[-1, :-1]) - np.eye(len(inside))).max(initial=0)) if len(inside) else None
    shares = [float(v / trace) if ok else 0.0 for v, ok in zip(values, varies, strict=True)]
    return dealt.join(made.select("key", F.explode("parts").alias("part"), "deviation", "white"), ["key", "part"]).select(
        "vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("at") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
