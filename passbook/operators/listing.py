"""Helpers for report listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_all(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in df.columns])


def largest_first(df: DataFrame, column: str) -> DataFrame:
    """Descending by one column; the other columns break ties.

    A range-partitioned sort cannot split equal keys, so the ties also keep a
    value that holds much of the listing from landing in one task.
    """
    ties = [F.col(name).asc_nulls_last() for name in df.columns if name != column]
    return df.orderBy(F.col(column).desc_nulls_last(), *ties)


def with_total_row(df: DataFrame, measures: list[str]) -> DataFrame:
    """The listing plus one row of grand totals, flagged by ``is_total``."""
    totals = df.agg(*[F.sum(name).alias(name) for name in measures])
    return df.withColumn("is_total", F.lit(False)).unionByName(
        totals.withColumn("is_total", F.lit(True)), allowMissingColumns=True
    )
