"""Period sums and validity ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark has no quarter unit; three months is the same interval.
PERIODS = {
    "day": "interval 1 day",
    "week": "interval 7 days",
    "month": "interval 1 month",
    "quarter": "interval 3 months",
    "year": "interval 1 year",
}


def period_sums(amount: Column, at: Column, end: Column) -> list[Column]:
    """One aggregate per period back from ``end``, both bounds inclusive.

    All periods come out of one aggregation instead of one filtered scan each.
    """
    return [
        F.coalesce(
            F.sum(F.when(at.between(end - F.expr(length), end), amount)), F.lit(0)
        )
        .cast("decimal(38,2)")
        .alias(f"amount_past_{name}")
        for name, length in PERIODS.items()
    ]


def join_valid_periods(
    days: DataFrame, periods: DataFrame, day: str, start: str, end: str
) -> DataFrame:
    """Left join of days to the periods that contain them, as an equi join.

    Each period is clipped to the days at hand and unfolded to one row per day,
    which are the rows the range join would emit; an open end costs nothing.
    """
    first = days.agg(F.min(day)).scalar()
    last = days.agg(F.max(day)).scalar()
    unfolded = (
        periods.withColumn("_from", F.greatest(F.col(start), first))
        .withColumn("_to", F.least(F.col(end), last))
        .where(
            F.col(start).isNotNull()
            & F.col(end).isNotNull()
            & (F.col("_from") <= F.col("_to"))
        )
        .withColumn(day, F.explode(F.sequence("_from", "_to")))
        .drop("_from", "_to")
    )
    return days.join(unfolded, day, "left")
