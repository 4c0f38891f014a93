"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

A stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``; the last
adds ``mix_weight`` and ``mix_copies``. Documents that a stage has nothing against stay. Decisions go by row: of two texts under one
id, each has its own. Rows without an id are judged like any other by language and benchmark and read by mixing; line dedup
and near-duplicates, which name documents by id, leave them as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curvelake.llm import decontam, langid, lines, mixing, simhash
from curvelake.llm.common import table, written

#: Dimensions of the language stage. The best cosine of a text in an unlearned script has a mean of about 0.02 and a standard
#: deviation of about 0.016 there.
DIMENSIONS = 2048
#: Texts whose best cosine with a language is lower belong to none of the learned ones: five deviations above that mean.
MIN_COSINE = 0.1
#: Texts of fewer three-letter windows are too short to tell and stay.
MIN_WINDOWS = 24


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those unlike every learned language that are long enough to tell."""
    return langid.accepted(docs, MIN_COSINE, dimensions=DIMENSIONS, min_windows=MIN_WINDOWS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that five documents or more share stay in one of them."""
    return lines.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a test item go."""
    return decontam.without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its source's weight and how often it is read."""
    return mixing.mixed(docs)


STAGES = [("language", language), ("repeated_lines", repeated_lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixture", mixture)]
#: Fingerprints, profiles and spaced seeds are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = written(docs)
    return docs
