"""Writers that never overwrite a published table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvelake.operators.ranks import row_ranks


def format_doubles(df: DataFrame, digits: int = 12) -> DataFrame:
    """Doubles as text with ``digits`` significant digits and no padding zeros; NULL stays blank."""
    def text(name: str):
        shown = F.format_string(f"%.{digits}g", F.col(name))
        trimmed = F.regexp_replace(F.regexp_replace(shown, r"(\.[0-9]*[1-9])0+($|e)", "$1$2"), r"\.0+($|e)", "$1")
        return F.when(F.col(name).isNotNull(), trimmed).alias(name)

    return df.select(*[
        text(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields])


def write_partitioned(df: DataFrame, path: str, *by: str, rows_per_file: int = 4_000_000) -> None:
    """Publish as Parquet, partitioned, failing if the table exists.

    The rows of a partition meet in as many files as they fill, so that a large partition is written by many tasks and a small one is one file.
    """
    sizes = df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_files"))
    dealt = df.join(sizes, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], "left").select(*df.columns, "_files")
    dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(*df.columns), F.col("_files")))
    dealt.repartition(*by, "_file").drop("_files", "_file").write.mode("errorifexists").partitionBy(*by).parquet(path)


def write_ordered(df: DataFrame, path: str, keys: Sequence[str], rows_per_file: int = 1_000_000) -> None:
    """Publish as Parquet in the order of ``keys``: folders ``file=0``, ``file=1`` ... of one sorted file each.

    Files hold ``rows_per_file`` rows (the last one fewer) and their bounds do not overlap. ``keys`` must be unique. Rows are numbered
    by range partitions and counts per range, so no task sees more than a range and a file.
    """
    ranked = row_ranks(df.withColumn("_all", F.lit(0)), ["_all"], keys).drop("_all", "group_rows")
    numbered = ranked.withColumn("file", F.floor((F.col("rank") - 1) / rows_per_file).cast("bigint")).drop("rank")
    numbered.repartition("file").sortWithinPartitions("file", *keys).write.mode("errorifexists").partitionBy("file").parquet(path)


def ordered_files(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Each numbered file of an ordered table with its first and last keys, its rows, and the part files it has (one)."""
    rows = spark.read.parquet(path).select("file", F.col("_metadata.file_path").alias("_path"), *keys)
    at = F.struct(*keys)
    return rows.groupBy("file").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("rows"), F.count_distinct("_path").alias("parts"))


def write_csv(df: DataFrame, path: str) -> None:
    format_doubles(df).write.mode("errorifexists").option("header", True).csv(path)


def write_archive(documents: DataFrame, path: str) -> None:
    """Publish small documents (``file``: its name, ``value``: its text, as it is) as JSON lines of some large files, one line each."""
    documents.select("file", "value").write.mode("errorifexists").json(path)


def write_checks(checks: DataFrame, path: str) -> None:
    """Publish a check table as JSON lines."""
    checks.write.mode("errorifexists").json(path)
