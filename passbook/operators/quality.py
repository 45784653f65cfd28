"""Data-quality checks as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"
ROWS = "_rows"


class QualityError(AssertionError):
    """A check of severity ``error`` has failures."""


@dataclass(frozen=True)
class Check:
    """A named check; ``failing`` holds the offending rows."""

    name: str
    failing: DataFrame
    severity: str = ERROR


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counted = df.agg(
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns]
    )
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_nulls"))
        for name in columns
    ]
    return counted.select(F.inline(F.array(*pairs)))


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child values without a parent, with their row counts.

    Both sides are reduced to one row per value first, so a hot value crosses
    the network as one row per task.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )
    known = parent.select(F.col(key).alias("value")).distinct()
    return values.join(known, "value", "left_anti")


def run_checks(checks: list[Check]) -> DataFrame:
    """One row per check: name, severity, failing rows and status."""
    rows = [
        check.failing.agg(F.count("*").alias("n_failures")).select(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            "n_failures",
            F.when(F.col("n_failures") == 0, "pass")
            .otherwise("warn" if check.severity == WARN else "fail")
            .alias("status"),
        )
        for check in checks
    ]
    return reduce(DataFrame.unionByName, rows)


def null_checks(table: str, df: DataFrame, severities: dict[str, str]) -> DataFrame:
    """Check rows for the NULLs of several columns, from one pass over a table."""
    counts = null_counts(df, list(severities))
    warn_only = [name for name, severity in severities.items() if severity == WARN]
    lenient = F.col("column_name").isin(*warn_only) if warn_only else F.lit(False)
    return counts.select(
        F.concat(F.lit(f"not_null {table}."), "column_name").alias("check_name"),
        F.when(lenient, WARN).otherwise(ERROR).alias("severity"),
        F.col("n_nulls").alias("n_failures"),
        F.when(F.col("n_nulls") == 0, "pass")
        .when(lenient, "warn")
        .otherwise("fail")
        .alias("status"),
    )


def status_of(n_failures: int, severity: str) -> str:
    return "pass" if n_failures == 0 else "warn" if severity == WARN else "fail"


def told_checks(spark: SparkSession, counts: dict[str, tuple[str, int]]) -> DataFrame:
    """Check rows from counts that are known already: name to severity and failures."""
    rows = [(name, severity, n, status_of(n, severity)) for name, (severity, n) in counts.items()]
    return spark.createDataFrame(rows, "check_name string, severity string, n_failures long, status string")


def unique_checks(columns: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Check rows for unique columns, name to table, column and severity.

    The values of all columns go through one aggregation, tagged by their check.  NULLs
    are left out, and a check without any value passes.
    """
    values = [
        df.select(F.lit(name).alias("check_name"), F.col(column).cast("string").alias("value"))
        for name, (df, column, _) in columns.items()
    ]
    repeated = (
        reduce(DataFrame.unionByName, values)
        .where("value IS NOT NULL")
        .groupBy("check_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("check_name")
        .agg(F.count_if(F.col("n") > 1).alias("n_failures"))
    )
    spark = next(iter(columns.values()))[0].sparkSession
    names = [(name, severity) for name, (_, _, severity) in columns.items()]
    failures = F.coalesce("n_failures", F.lit(0))
    return (
        spark.createDataFrame(names, "check_name string, severity string")
        .join(repeated, "check_name", "left")
        .select(
            "check_name",
            "severity",
            failures.alias("n_failures"),
            F.when(failures == 0, "pass")
            .when(F.col("severity") == WARN, "warn")
            .otherwise("fail")
            .alias("status"),
        )
    )


def watched(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows and of the NULLs of ``columns``.

    The counts are taken by the action that writes ``df``, so no scan is spent on them.
    """
    seen = Observation()
    nulls = [F.count_if(F.col(name).isNull()).alias(name) for name in columns]
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS), *nulls), seen


def raise_on_errors(report: DataFrame) -> DataFrame:
    """Raise when an ``error`` check failed; warnings pass through."""
    failed = [row.check_name for row in report.where("status = 'fail'").collect()]
    if failed:
        raise QualityError("failed checks: " + ", ".join(sorted(failed)))
    return report


def is_empty(df: DataFrame) -> bool:
    """The table-must-be-empty test; stops at the first row."""
    return not df.limit(1).count()


def category_coverage(merchants: DataFrame) -> DataFrame:
    """Per category: net amount, merchant keys and transactions."""
    return merchants.groupBy("merchant_category").agg(
        F.sum("total_amount").cast("decimal(38,2)").alias("net_amount"),
        F.count("*").alias("merchant_keys"),
        F.sum("total_transactions").alias("transactions"),
    )


def coverage_summary(merchants: DataFrame, unknown: str) -> DataFrame:
    """Transactions, merchant keys and keys without a category."""
    return merchants.agg(
        F.sum("total_transactions").alias("unique_transactions"),
        F.count("*").alias("merchant_keys"),
        F.count_if(F.col("merchant_category") == unknown).alias("unknown_keys"),
    )


def require_coverage(merchants: DataFrame, unknown: str) -> DataFrame:
    """The merchants, or an error when one has no category."""
    missing_keys = coverage_summary(merchants, unknown).first().unknown_keys
    if missing_keys:
        raise QualityError(f"{missing_keys} merchant keys without a category")
    return merchants


def unknown_merchants(merchants: DataFrame, unknown: str) -> DataFrame:
    """Merchants to map next, busiest first."""
    return (
        merchants.where(F.col("merchant_category") == unknown)
        .select("merchant_name", "total_transactions")
        .orderBy(F.col("total_transactions").desc(), "merchant_name")
    )
