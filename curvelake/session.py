"""Session helpers: reliable checkpoints, stage tables and partitioning for heavy rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="curvelake-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoints, which every executor reaches; it goes when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so iterative work re-reads it instead of recomputing it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by keys for work that is heavy per byte.

    Adaptive execution sizes partitions by bytes, which would leave a small table
    of expensive rows (likelihoods, curve fits) on a few cores. An explicit number
    keeps every core busy, and a later grouping by the same keys needs no shuffle.
    """
    spark = df.sparkSession
    # A chosen number of shuffle partitions is respected; Spark's fixed default says nothing about the cluster.
    chosen = int(spark.conf.getAll.get("spark.sql.shuffle.partitions", 0))
    number = max(spark.sparkContext.defaultParallelism, chosen)
    return df.repartition(number, *keys)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Partition by keys into as many tasks as ``rows`` rows each make, so that a task's memory does not grow with the table.

    A later grouping or window by the same keys and more needs no shuffle. Counting reads ``df`` once more: it should be a scan.
    """
    number = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(number, *keys)


def growing(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: its rows meet the other side's in shuffled parts and never pass the driver.

    Without the hint a table is broadcast, through the driver, as long as its files or shuffled bytes are compressed to less than the limit.
    """
    return df.hint("merge")


def hashed(df: DataFrame) -> DataFrame:
    """The smaller side of a join whose sides both grow, with few rows per key: met in shuffled parts, like ``growing``.

    A task hashes its part of this side, so that the rows of the other, far larger one need not be sorted.
    """
    return df.hint("shuffle_hash")


_STAGES: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def _stamp(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of what lies in the folder: a changed table gets a new stamp."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return "|".join(sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in found))


def stage(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A stage table: built and materialised once per application and input folder, anew when the folder changes.

    Later stages and queries read it from the checkpoint folder instead of
    repeating everything upstream of it. ``free_stages`` forgets them; Spark's
    cleaner then removes their files where ``cleanCheckpoints`` is set.
    """
    @wraps(build)
    def read(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder, f"{build.__module__}.{build.__name__}")
        stamp = _stamp(spark, folder)
        if key not in _STAGES or _STAGES[key][0] != stamp:
            _STAGES[key] = (stamp, cut(build(spark, folder)))
        return _STAGES[key][1]
    return read


def free_stages() -> None:
    _STAGES.clear()
