"""Readers with explicit schemas."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvelake import schemas


def read_weekly(spark: SparkSession, path: str) -> DataFrame:
    """Weekly history from CSV (plain or compressed): every column as text, coerced later by name.

    A ``.gz`` file cannot be split; land it once with ``write_partitioned`` and
    read that table at scale.
    """
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def read_snapshot(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A source's snapshot documents (one JSON object per file); unreadable documents are an error."""
    schema = schemas.BOOK_SNAPSHOT if kind == "book" else schemas.CONTRACT_SNAPSHOT
    documents = spark.read.schema(schema).option("multiLine", True).option(
        "columnNameOfCorruptRecord", "_corrupt_record").json(path)
    empty = F.col("metadata").isNull() & F.col("markets").isNull()
    broken = documents.filter(F.col("_corrupt_record").isNotNull() | empty).limit(1).count()
    if broken:
        raise ValueError(f"unreadable snapshot document under {path}")
    return documents.drop("_corrupt_record")


def read_documents(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Snapshot documents under a folder, one row per file, however many there are.

    ``file`` is the path below ``path``; partition folders become columns. A file that is no JSON object of
    the snapshot's kind stays, with its text in ``_corrupt_record`` and nothing else, so that a gate can name it.
    """
    files = spark.read.text(path, wholetext=True)
    parts = [c for c in files.columns if c != "value"]
    start = F.instr(F.col("_metadata.file_path"), path.rstrip("/").rsplit("/", 1)[-1] + "/") + len(path.rstrip("/").rsplit("/", 1)[-1]) + 1
    found = parse_documents(files.select(*parts, F.substr(F.col("_metadata.file_path"), start).alias("file"), "value"), kind)
    fields = [c for c in found.columns if c not in (*parts, "file", "_corrupt_record")]
    # A scan skips files without a byte; the listing knows them.
    empty = [(p.split(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1],) for p, size in file_sizes(spark, path) if not size]
    if not empty:
        return found
    lost = spark.createDataFrame(empty, "file string").select(
        *[F.regexp_extract("file", f"(?:^|/){c}=([^/]*)", 1).cast(found.schema[c].dataType).alias(c) for c in parts], "file",
        *[F.lit(None).cast(found.schema[f].dataType).alias(f) for f in fields], F.lit("").alias("_corrupt_record"))
    return found.unionByName(lost)


def read_archive(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The documents of an archive (``write_archive``), as ``read_documents`` gives them: one row per document under its own ``file``.

    Many small documents fill few large files, which list and scan like any table; a document without text is a line like the others.
    """
    lines = spark.read.schema("file string, value string").json(path)
    return parse_documents(lines.select("file", F.coalesce("value", F.lit("")).alias("value")), kind)


def parse_documents(texts: DataFrame, kind: str) -> DataFrame:
    """Texts ``value`` as snapshot documents of a kind, beside the other columns; one that is no such object stays in ``_corrupt_record``."""
    schema = schemas.BOOK_SNAPSHOT if kind == "book" else schemas.CONTRACT_SNAPSHOT
    others = [c for c in texts.columns if c != "value"]
    document = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = texts.select(*others, "value", document.alias("d"))
    whole = F.trim("value").startswith("{") & F.col("d").isNotNull() & F.col("d._corrupt_record").isNull()
    fields = [f.name for f in parsed.schema["d"].dataType.fields if f.name != "_corrupt_record"]
    return parsed.select(*others, *[F.when(whole, F.col(f"d.{f}")).alias(f) for f in fields], F.when(~F.coalesce(whole, F.lit(False)), F.col("value")).alias("_corrupt_record"))


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The data files below a folder and their bytes, from its listing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, out = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True), []
    while found.hasNext():
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            out.append((status.getPath().toString(), status.getLen()))
    return sorted(out)


def file_paths(spark: SparkSession, path: str) -> list[str]:
    return [name for name, _ in file_sizes(spark, path)]


def headers_of(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line: one short read per file, like the listing itself, and no more than that of the data."""
    def first_line(path: str) -> tuple[str, ...]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
        opened = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
        stream = opened if codec is None else codec.createInputStream(opened)
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        return tuple(next(csv.reader([line.removeprefix("\ufeff")]))) if line else ()

    with ThreadPoolExecutor(16) as pool:
        found = dict(zip(paths, pool.map(first_line, paths), strict=True))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in found.items():
        groups.setdefault(header, []).append(path)
    return groups


def read_differing(spark: SparkSession, path: str, required: Mapping[str, Sequence[str]], optional: Mapping[str, Sequence[str]]) -> DataFrame:
    """CSV files whose headers differ, as one table of canonical text columns.

    Each file's columns are resolved by its own header: the first accepted name that it carries. A file without a required
    column is an error that names the file; an optional one is NULL. Files of one header are one scan. Other columns are left unread.
    """
    parts = []
    for header, files in headers_of(spark, file_paths(spark, path)).items():
        if not header:
            continue  # an empty file has no rows
        picked = []
        for canonical, accepted in (required | optional).items():
            name = next((a for a in accepted if a in header), None)
            if name is None and canonical in required:
                raise ValueError(f"{files[0]} lacks {canonical}; accepted names: {', '.join(accepted)}")
            picked.append((F.lit(None).cast("string") if name is None else F.col(f"`{name}`")).alias(canonical))
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        parts.append(spark.read.schema(schema).option("header", True).option("nullValue", "").csv(files).select(*picked))
    if not parts:
        raise ValueError(f"no file with a header under {path}")
    return reduce(DataFrame.unionByName, parts)


def read_typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Re-read a published CSV: fields coerced one by one, blanks and junk as NULL."""
    wanted = T._parse_datatype_string(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    raw = spark.read.schema(text).option("header", True).option("nullValue", "").csv(path)
    return raw.select(*[F.nullif(F.trim(F.col(f.name)), F.lit("")).try_cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    names = spark.read.option("header", True).csv(path).columns
    missing = {"source", "raw_player_name", "canonical_player_id", "canonical_player_name"} - set(names)
    if missing:
        raise ValueError(f"alias file lacks: {', '.join(sorted(missing))}")
    return read_typed_csv(spark, path, ", ".join(f"{n} string" for n in names))


def source_profile(table: DataFrame) -> DataFrame:
    """Covered seasons and the header of an input table, one row."""
    seasons = table.select(F.col("season").try_cast("int").alias("season")).distinct()
    return seasons.agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season"), F.count("season").alias("seasons"),
        F.array_join(F.array_sort(F.collect_list("season")), "|").alias("covered_seasons"),
    ).withColumn("header", F.lit("|".join(table.columns)))
