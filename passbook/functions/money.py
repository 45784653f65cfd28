"""Arithmetic whose type is chosen by cast rather than by default rules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL instead of an error when the denominator is zero."""
    bottom = denominator.cast("double")
    return F.when(bottom != 0, numerator.cast("double") / bottom)


def rounded(value: Column, places: int) -> Column:
    """Half away from zero on the scaled double, the way the marts round.

    ``F.round`` works on the shortest decimal text of a double instead, which
    differs for values such as 0.285.
    """
    scale = 10**places
    return F.round(value * scale) / scale


def double_to_decimal(value: Column, precision: int, scale: int) -> Column:
    """Safe cast of a double, rounded like ``rounded``; NULL when too large."""
    return rounded(value, scale).try_cast(f"decimal({precision},{scale})")


def mean_of_cents(total: Column, count: Column) -> Column:
    """Average of a decimal(.., 2) column from its exact sum, as double."""
    return (total * 100).cast("double") / (count * 100)


def flipped(amount: Column, dtype: str) -> Column:
    return (-amount).cast(dtype)


def safe_input(value: object, dtype: str, default: object) -> Column:
    """A user-typed value, or the default when it does not parse."""
    fallback = F.lit(str(default)).cast(dtype)
    if value is None:
        return fallback
    return F.coalesce(F.lit(str(value)).try_cast(dtype), fallback)


def decimal_or_zero(amount: Column, dtype: str) -> Column:
    return F.coalesce(amount, F.lit(Decimal(0))).cast(dtype)
