"""Where queries register, and the shapes in which they return their rows.

Values are rounded only here, for comparison with the SQL equivalents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.operators import checks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and decimals, and widen integers."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "double" or kind.startswith("decimal"):
            out.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        elif kind in ("int", "smallint", "tinyint"):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def gate(table: DataFrame) -> DataFrame:
    return table.select("name", "passed", "severity")


def detailed(table: DataFrame) -> DataFrame:
    """Checks with their details as JSON text, keys in order."""
    return table.select("name", "passed", "severity", F.to_json(checks.sorted_map("details")).alias("details"))
