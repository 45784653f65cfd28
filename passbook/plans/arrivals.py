"""Freshness of arriving snapshots and the rule that admits them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.functions.calendar import as_timestamp
from passbook.sources.snapshots import BALANCE_DATE_IN_NAME


def freshness_from_names(files: DataFrame, filename: str = "filename") -> DataFrame:
    """Newest balance date per stored file, read from its name alone."""
    epoch = F.regexp_extract(filename, BALANCE_DATE_IN_NAME, 1)
    return files.select(
        F.col(filename).alias("filename"),
        F.when(epoch != "", epoch).try_cast("bigint").alias("balance_epoch"),
    )


def freshness_from_content(snapshots: DataFrame) -> DataFrame:
    """Newest balance date and account count per file, from the documents.

    Both are array expressions on the row: nothing is exploded or shuffled.
    A balance date of zero counts as absent.
    """
    dates = F.transform("accounts", lambda a: a["balance-date"])
    return snapshots.select(
        "filename",
        F.array_max(F.filter(dates, lambda d: d != 0)).alias("balance_epoch"),
        F.coalesce(F.size("accounts"), F.lit(0)).alias("n_accounts"),
    )


def stored_recently(freshness: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Stored files in the folders of today and yesterday."""
    today = as_timestamp(now).cast("date")
    dated = F.regexp_extract("filename", r"/(\d{4}/\d{2}/\d{2})/[^/]*$", 1)
    folder = F.try_to_timestamp(dated, F.lit("yyyy/MM/dd")).cast("date")
    return freshness.where(folder.isin(today, F.date_sub(today, 1)))


def admit(candidates: DataFrame, stored: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Decide per candidate: captured_today, empty, not_newer or new.

    ``candidates`` has filename, balance_epoch and n_accounts; ``stored`` has
    balance_epoch.  A new file without a balance date is marked with ``now``.
    """
    moment = as_timestamp(now)
    day_of_epoch = F.timestamp_seconds("balance_epoch").cast("date")
    newest = stored.agg(F.max("balance_epoch")).scalar()
    today = stored.agg(
        F.coalesce(F.bool_or(day_of_epoch == moment.cast("date")), F.lit(False))
    ).scalar()
    decision = (
        F.when(today, "captured_today")
        .when(F.col("n_accounts") == 0, "empty")
        .when(F.col("balance_epoch") <= newest, "not_newer")
        .otherwise("new")
    )
    marker = F.coalesce("balance_epoch", F.unix_timestamp(moment))
    return candidates.withColumn("decision", decision).withColumn(
        "marker", F.when(F.col("decision") == "new", marker)
    )
