"""The star schema: accounts, transactions, merchants, calendar and pay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passbook.functions.calendar import (
    AsOf,
    as_date,
    as_timestamp,
    days_in_month,
    iso_weekday,
    utinyint,
)
from passbook.functions.money import double_to_decimal, ratio
from passbook.functions.text import merchant_key
from passbook.operators.categorize import categorize
from passbook.operators.contract import enforce_contract
from passbook.operators.latest import Staged, latest_by, repeats_apart
from passbook.operators.periods import PERIODS, join_valid_periods, period_sums
from passbook.sources.defaults import CALENDAR_END, CALENDAR_START
from passbook.sources.snapshots import flatten_accounts, flatten_transactions
from passbook.sources.spine import date_spine


def latest_accounts(flat: DataFrame) -> DataFrame:
    """The newest balance per account name; ids may change between snapshots."""
    return latest_by(
        flat,
        ["bank_account_name"],
        newest="balance_as_of_timestamp",
        ties=[
            "filename",
            "bank_account_id",
            "currency",
            "actual_balance",
            "available_balance",
        ],
    )


def dim_accounts(snapshots: DataFrame, loaded_at: Column | str | None = None) -> DataFrame:
    return accounts_from_flat(flatten_accounts(snapshots), loaded_at)


def accounts_from_flat(flat: DataFrame, loaded_at: Column | str | None = None) -> DataFrame:
    return enforce_contract(
        latest_accounts(flat).withColumn("record_loaded_at_timestamp", as_timestamp(loaded_at)),
        "dim_accounts",
    )


def latest_transactions(flat: DataFrame, *last_ties: str) -> DataFrame:
    """One row per transaction id, the latest posting wins.

    Overlapping snapshots repeat a transaction unchanged; the file name and the
    remaining columns make the choice among equals deterministic.  Of rows alike in all
    these, the larger ``last_ties`` win.
    """
    return latest_by(
        flat,
        ["txn_id"],
        newest="posted_at_timestamp",
        ties=[
            "filename",
            "bank_account_id",
            "bank_account_name",
            "txn_description",
            "payee",
            "amount",
            *last_ties,
        ],
    )


def latest_of_stored(flat: DataFrame, staged: Staged) -> DataFrame:
    """``latest_transactions`` of a stored table; only rows whose id may repeat are shuffled.

    Rows of a transaction store have an id of their own.  Where pulls repeat most ids,
    finding that out costs one more shuffle, of hashes.
    """
    once, several = repeats_apart(flat, ["txn_id"], staged)
    return once if several is None else once.unionByName(latest_transactions(several))


def derived_columns(table: str) -> dict[str, Column]:
    """Columns of a table that its other columns fix; a sort of its rows need not carry them."""
    if table == "fact_transactions":
        return {"merchant_category_key": merchant_key(F.col("payee"), F.col("txn_description"))}
    return {}


def as_fact(latest: DataFrame, loaded_at: Column | str | None = None) -> DataFrame:
    """Merchant key and load time added to rows that are unique by id."""
    fact = latest.withColumns(
        {
            "merchant_category_key": merchant_key(
                F.col("payee"), F.col("txn_description")
            ),
            "record_loaded_at_timestamp": as_timestamp(loaded_at),
        }
    )
    return enforce_contract(fact, "fact_transactions")


def fact_from_flat(flat: DataFrame, loaded_at: Column | str | None = None) -> DataFrame:
    """The transaction fact from flattened snapshot rows."""
    return as_fact(latest_transactions(flat), loaded_at)


def fact_transactions(
    snapshots: DataFrame, loaded_at: Column | str | None = None
) -> DataFrame:
    return fact_from_flat(flatten_transactions(snapshots), loaded_at)


def dim_date(
    spark: SparkSession,
    start: str | Column = CALENDAR_START,
    end: str | Column = CALENDAR_END,
    corrected: bool = False,
) -> DataFrame:
    """The calendar.

    The year does not fit an unsigned byte, so it is NULL by default;
    ``corrected`` keeps it.
    """
    day = F.col("date_day")
    weekday = iso_weekday(day)
    year = F.year(day)
    calendar = date_spine(spark, start, end).select(
        day.alias("full_date"),
        (year.cast("smallint") if corrected else utinyint(year)).alias("date_year"),
        utinyint(F.quarter(day)).alias("date_quarter"),
        utinyint(F.month(day)).alias("date_month"),
        F.date_format(day, "MMMM").alias("name_date_month"),
        utinyint(days_in_month(day)).alias("total_days_in_month"),
        utinyint(F.weekofyear(day)).alias("date_week"),
        utinyint(weekday).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("name_day_of_week"),
        weekday.isin(6, 7).alias("is_weekend_ind"),
    )
    return enforce_contract(calendar, "dim_date")


def fact_daily_pay(
    calendar: DataFrame, pay_rates: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Pay per calendar day up to ``as_of``: two checks spread over the month.

    A day in no pay period has NULL income; a day in two periods has two rows.
    """
    days = calendar.where(F.col("full_date") <= as_date(as_of)).select(
        "full_date", "date_quarter", "total_days_in_month"
    )
    paid = join_valid_periods(
        days, pay_rates, "full_date", "effective_start_date", "effective_end_date"
    )
    monthly = F.col("biweekly_paycheck_posttax_amount") * 2
    return enforce_contract(
        paid.select(
            F.col("full_date").alias("calendar_date"),
            F.col("date_quarter").alias("calendar_quarter"),
            double_to_decimal(
                ratio(monthly, F.col("total_days_in_month")), 12, 2
            ).alias("daily_income"),
            F.col("employer_name").alias("from_employer"),
        ),
        "fact_daily_pay",
    )


def dim_merchant(
    fact: DataFrame,
    catalog: DataFrame,
    loaded_at: Column | str | None = None,
    newest: Column | None = None,
) -> DataFrame:
    """One row per merchant key with totals, period sums and a category.

    ``fact`` holds one row per transaction id, so counting ids counts distinct
    ids.  Patterns are matched after aggregation: once per distinct description,
    not once per transaction.  Period sums end at ``newest``, by default the last
    posting of ``fact``.
    """
    if newest is None:
        newest = fact.agg(F.max("posted_at_timestamp")).scalar()
    posted, amount = F.col("posted_at_timestamp"), F.col("amount")
    merchants = (
        fact.select(
            F.lower("payee").alias("merchant_name"),
            F.lower("txn_description").alias("txn_description"),
            "txn_id",
            posted,
            amount,
            newest.alias("_newest"),
        )
        .groupBy("merchant_name", "txn_description")
        .agg(
            F.min(posted).alias("earliest_txn_at"),
            F.max(posted).alias("latest_txn_at"),
            F.count("txn_id").alias("total_transactions"),
            F.sum(amount).cast("decimal(38,2)").alias("total_amount"),
            *period_sums(amount, posted, F.col("_newest")),
        )
        .withColumn(
            "merchant_category_key",
            merchant_key(F.col("merchant_name"), F.col("txn_description")),
        )
    )
    labelled = categorize(merchants, catalog, "txn_description")

    # Two payee and description pairs can share a key when they contain the
    # separator; the best categorised pair stands for it, periods cover both.
    same_key = Window.partitionBy("merchant_category_key")
    best = same_key.orderBy(
        *[
            F.col(name).asc_nulls_last()
            for name in (
                "match_priority",
                "merchant_category",
                "merchant_subcategory",
                "merchant_name",
                "txn_description",
            )
        ]
    )
    periods = {
        f"amount_past_{name}": F.sum(f"amount_past_{name}")
        .over(same_key)
        .cast("decimal(38,2)")
        for name in PERIODS
    }
    one_per_key = (
        labelled.withColumns({**periods, "_rank": F.row_number().over(best)})
        .where(F.col("_rank") == 1)
        .withColumn("record_updated_at", as_timestamp(loaded_at))
        .drop("_rank", "txn_description", "match_priority")
    )
    return enforce_contract(one_per_key, "dim_merchant")
