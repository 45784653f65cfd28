"""Date and small-integer column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | Column | None


def as_date(as_of: AsOf) -> Column:
    """The reporting date: given, or today when ``None``."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def as_timestamp(moment: dt.datetime | str | Column | None) -> Column:
    if moment is None:
        return F.current_timestamp()
    if isinstance(moment, Column):
        return moment
    return F.lit(moment).cast("timestamp")


def utinyint(col: Column) -> Column:
    """Safe cast to an unsigned byte: NULL outside 0..255, held as SMALLINT."""
    return F.when(col.between(0, 255), col).cast("smallint")


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def days_in_month(col: Column) -> Column:
    return F.dayofmonth(F.last_day(col))


def iso_weekday(col: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(col) + 1


def month_span(start: Column, end: Column) -> Column:
    """Month boundaries crossed from start to end, not whole months elapsed."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def day_span(start: Column, end: Column) -> Column:
    """Day boundaries crossed from start to end."""
    return F.datediff(end, start).cast("bigint")


def trailing_months(ts: Column, months: int, as_of: AsOf = None) -> Column:
    """Rows of the as-of month and of the ``months`` months before it.

    Written as a range over the bare column, so the bounds fold to literals and
    reach the parquet scan; wrapping the column in ``date_trunc`` would not.
    """
    first_of_month = month_start(as_date(as_of))
    start = F.add_months(first_of_month, -months).cast("timestamp")
    end = F.add_months(first_of_month, 1).cast("timestamp")
    return (ts >= start) & (ts < end)


def up_to_day_of_month(col: Column, as_of: AsOf = None) -> Column:
    return F.dayofmonth(col) <= F.dayofmonth(as_date(as_of))
