"""The calendar spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str | Column, end: str | Column) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    first, stop = (
        bound if isinstance(bound, Column) else F.lit(bound).cast("date")
        for bound in (start, end)
    )
    bounds = spark.range(1).select(first.alias("first"), F.date_sub(stop, 1).alias("last"))
    return bounds.where("first <= last").select(
        F.explode(F.sequence("first", "last")).alias("date_day")
    )
