"""Data-quality checks as tables: one row per check, fail-closed on errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A stage failed at least one error-level check."""


@dataclass(frozen=True)
class Check:
    """A named condition over the columns of an aggregated table."""

    name: str | Column
    passed: Column
    message: str
    severity: str = "error"
    details: Mapping[str, Column] = field(default_factory=dict)

    def row(self) -> Column:
        name = self.name if isinstance(self.name, Column) else F.lit(self.name)
        pairs = [x for key, value in self.details.items() for x in (F.lit(key), value.cast("string"))]
        details = F.create_map(*pairs) if pairs else F.map_from_arrays(
            F.array().cast("array<string>"), F.array().cast("array<string>"))
        return F.struct(
            name.alias("name"), F.coalesce(self.passed, F.lit(False)).alias("passed"),
            F.lit(self.severity).alias("severity"), F.lit(self.message).alias("message"),
            details.cast("map<string,string>").alias("details"))


def check_table(aggregated: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One output row per check and per row of ``aggregated`` (usually a single row)."""
    return aggregated.select(F.inline(F.array(*[check.row() for check in checks])))


def all_checks(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once at a declared grain."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def grain_check(df: DataFrame, keys: Sequence[str], name: str, message: str, samples: int = 5) -> DataFrame:
    """Uniqueness of a grain, with the first few offending keys."""
    repeated = duplicate_keys(df, keys).select("rows", F.concat_ws("/", *keys).alias("key"))
    some = repeated.select("key").orderBy("key").limit(samples).withColumn("rows", F.lit(None).cast("bigint"))
    counted = repeated.select(F.lit(None).cast("string").alias("key"), "rows").unionByName(some).agg(
        F.count("rows").alias("duplicate_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("duplicate_rows"),
        F.array_join(F.array_sort(F.collect_list("key")), ", ").alias("sample"))
    return check_table(counted, [Check(name, F.col("duplicate_keys") == 0, message, details={
        c: F.col(c) for c in ("duplicate_keys", "duplicate_rows", "sample")})])


def missing_values(df: DataFrame, expected: Sequence, column: str) -> DataFrame:
    """Expected values that the column never takes."""
    kind = df.schema[column].dataType
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], "v " + (
        "long" if isinstance(expected[0], int) else "string")).select(F.col("v").cast(kind).alias(column))
    return wanted.join(df.select(column).distinct(), column, "left_anti")


def gate_status(checks: DataFrame, fail_on_warning: bool = False) -> DataFrame:
    """Roll a check table up to one status row."""
    errors = F.count_if(~F.col("passed") & (F.col("severity") == "error"))
    warnings = F.count_if(~F.col("passed") & (F.col("severity") == "warning"))
    failing = (errors > 0) | (warnings > 0) if fail_on_warning else errors > 0
    return checks.agg(
        F.when(failing, "failed").otherwise("passed").alias("status"),
        F.count("*").alias("checks"), errors.alias("errors"), warnings.alias("warnings"))


def require(checks: DataFrame, fail_on_warning: bool = False) -> None:
    """Raise if any error-level check failed. All failed checks are named: their number is bounded by the rules."""
    wanted = ["error", "warning"] if fail_on_warning else ["error"]
    failed = checks.filter(~F.col("passed") & F.col("severity").isin(wanted)).collect()
    if failed:
        raise GateError("; ".join(f"{row['name']}: {row['message']} {row['details']}" for row in failed))


def failed_warnings(checks: DataFrame) -> DataFrame:
    """Warnings that fired, with their details as JSON text."""
    return checks.filter(~F.col("passed") & (F.col("severity") == "warning")).select(
        F.col("name").alias("check"), "message", F.to_json(sorted_map("details")).alias("details"))


def sorted_map(column: str) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(column)))
