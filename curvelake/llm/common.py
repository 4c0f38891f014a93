"""Helpers shared by the operators: batches of bounded size, written intermediate tables, stable splits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.session import checkpoint_dir

#: Letters between which words stand, in texts and in Python's ``bytes.split``.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder; lineage ends here and a lost executor costs nothing.

    The table goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def filtered(docs: DataFrame, keep: Callable[..., list[bool]], *args, rows: int = 256, size: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` whose text passes ``keep(texts, *args)``; each row is judged by itself, and nothing is shuffled."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, rows, size):
            yield piece.filter(pa.array(keep(piece.column(at).to_pylist(), *args), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def bucket_of(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most ``rows`` rows and about ``size`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(arrow_type(name[6:-1]))
    return {"bigint": pa.int64(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32()}[name]


def map_slices(df: DataFrame, compute: Callable[..., dict], schema: str, *args, rows: int = 256, size: int = 4 << 20) -> DataFrame:
    """``compute(piece, *args)`` gives a dict of columns for each Arrow piece of ``df``; ``schema`` is ``"name type, ..."``."""
    names = [part.split(None, 1) for part in schema.split(", ")]
    kind = pa.schema([(n, arrow_type(t)) for n, t in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, rows, size):
            made = compute(piece, *args)
            if made is not None:
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in kind], schema=kind)

    return df.mapInArrow(run, schema)
