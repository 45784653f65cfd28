"""Parameterised report queries over the marts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.functions.calendar import AsOf, day_span, month_span, trailing_months
from passbook.functions.money import safe_input
from passbook.functions.text import mentions
from passbook.operators.listing import largest_first, order_by_all

# Report parameters and the bounds used when an input is blank.
TRAILING_MONTHS = 6
SINGLE_SPEND_CAP = 500
EXCLUDED_WORD = "kratom"
CARD_ACCOUNT = "cashreward"
NO_DOLLAR_CAP = Decimal("999999999999.99")
FIRST_DAY = "1900-01-01"
LAST_DAY = "9999-12-31"


def _posted_date():
    return F.col("posted_at_timestamp").cast("date").alias("posted_date")


def _chosen(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Multi-select filter; ``None`` selects everything but NULL."""
    if values is None:
        return df.where(F.col(column).isNotNull())
    return df.where(F.col(column).isin(*values))


def _between_days(df: DataFrame, column: str, lower: object, upper: object) -> DataFrame:
    return df.where(
        F.col(column).between(
            safe_input(lower, "date", FIRST_DAY), safe_input(upper, "date", LAST_DAY)
        )
    )


# Balances -----------------------------------------------------------------


def balance_total(
    accounts: DataFrame, include: str | None = None, exclude: str | None = None
) -> DataFrame:
    """Sum of balances of accounts whose name has, or lacks, a word."""
    name = F.col("bank_account_name")
    if include is not None:
        accounts = accounts.where(mentions(name, include))
    if exclude is not None:
        accounts = accounts.where(~mentions(name, exclude))
    return accounts.agg(F.sum("actual_balance").cast("decimal(38,2)").alias("balance"))


def total_assets_minus_mortgage(accounts: DataFrame) -> DataFrame:
    return balance_total(accounts, exclude="mortgage")


def total_cc_debt(accounts: DataFrame) -> DataFrame:
    return balance_total(accounts, include="cashrewards")


def total_checking(accounts: DataFrame) -> DataFrame:
    return balance_total(accounts, include="check")


def total_mortgage(accounts: DataFrame) -> DataFrame:
    return balance_total(accounts, include="mortgage")


def total_savings1(accounts: DataFrame) -> DataFrame:
    return balance_total(accounts, include="market savings")


def total_savings2(accounts: DataFrame) -> DataFrame:
    return balance_total(accounts, include="share savings")


# Expenses -----------------------------------------------------------------


def chart_coe_expenses_detail(
    expenses: DataFrame,
    as_of: AsOf = None,
    category: str = "cost-of-living",
    cap: object = SINGLE_SPEND_CAP,
    months: int = TRAILING_MONTHS,
) -> DataFrame:
    """Monthly spend per subcategory of one category, large spends left out."""
    posted = F.col("posted_at_timestamp")
    return (
        expenses.where(
            (F.col("amount_spent") < F.lit(cap))
            & (F.col("merchant_category") == category)
            & trailing_months(posted, months, as_of)
        )
        .groupBy(
            F.date_format(posted, "yyyy-MM").alias("year_month"),
            F.col("merchant_subcategory").alias("subcategory"),
        )
        .agg(F.sum("amount_spent").cast("decimal(38,2)").alias("amount_spent"))
        .orderBy("year_month")
    )


def rows_all_expenses(expenses: DataFrame, excluded: str = EXCLUDED_WORD) -> DataFrame:
    """The expense listing without one excluded word."""
    label = F.concat("merchant_category", "merchant_subcategory")
    return largest_first(
        expenses.where(~mentions(label, excluded)).select(
            _posted_date(),
            "amount_spent",
            "merchant",
            F.col("merchant_category").alias("category"),
            F.col("merchant_subcategory").alias("subcategory"),
            F.col("txn_description").alias("description"),
            "account",
        ),
        "posted_date",
    )


def _trailing_listing(
    expenses: DataFrame, as_of: AsOf, months: int, columns: list
) -> DataFrame:
    """Recent rows, newest posting first; the sort key itself is not shown."""
    posted = F.col("posted_at_timestamp")
    recent = expenses.where(trailing_months(posted, months, as_of))
    shown = largest_first(recent.select(*columns, posted), "posted_at_timestamp")
    return shown.drop("posted_at_timestamp")


def rows_cc_interest_payments(
    expenses: DataFrame, as_of: AsOf = None, months: int = TRAILING_MONTHS
) -> DataFrame:
    interest = expenses.where(
        mentions(F.col("account"), CARD_ACCOUNT)
        & mentions(F.col("txn_description"), "interest")
    )
    columns = [
        _posted_date(),
        "amount_spent",
        F.col("merchant_category").alias("category"),
        F.col("merchant_subcategory").alias("subcategory"),
        "merchant",
        F.col("txn_description").alias("description"),
        "account",
    ]
    return _trailing_listing(interest, as_of, months, columns)


def rows_mortgage_payment(
    expenses: DataFrame, as_of: AsOf = None, months: int = TRAILING_MONTHS
) -> DataFrame:
    payments = expenses.where(mentions(F.col("txn_description"), "mortgage"))
    columns = [
        _posted_date(),
        F.col("txn_description").alias("description"),
        "amount_spent",
        "account",
    ]
    return _trailing_listing(payments, as_of, months, columns)


def rows_cc_spend(expenses: DataFrame) -> DataFrame:
    listing = rows_all_expenses(expenses)
    return largest_first(
        listing.where(mentions(F.col("account"), CARD_ACCOUNT)), "posted_date"
    )


def col_dollar_bounds(expenses: DataFrame) -> DataFrame:
    return rows_all_expenses(expenses).agg(
        F.min("amount_spent").alias("least_spent"),
        F.max("amount_spent").alias("most_spent"),
    )


def flt_chart_col_expenses(
    expenses: DataFrame,
    dollar_cap: object = None,
    categories: Sequence[str] | None = None,
    lower: object = None,
    upper: object = None,
) -> DataFrame:
    """Spend per category and subcategory; inputs that do not parse are ignored."""
    cap = safe_input(dollar_cap, "decimal(36,2)", NO_DOLLAR_CAP)
    rows = rows_all_expenses(expenses).where(F.col("amount_spent") <= cap)
    rows = _between_days(_chosen(rows, "category", categories), "posted_date", lower, upper)
    return order_by_all(
        rows.groupBy("category", "subcategory").agg(
            F.sum("amount_spent").cast("decimal(38,2)").alias("total_spend")
        )
    )


def unique_merch_cats(expenses: DataFrame) -> DataFrame:
    categories = rows_all_expenses(expenses).select("category").distinct()
    return categories.orderBy(F.col("category").asc_nulls_last())


def expenses_detail_bounds(expenses: DataFrame) -> DataFrame:
    posted = F.col("posted_at_timestamp")
    bounds = expenses.agg(F.min(posted).alias("start_date"), F.max(posted).alias("last"))
    return bounds.select(
        "start_date", day_span(F.col("start_date"), F.col("last")).alias("date_span")
    )


def flt_rows_all_expenses(
    expenses: DataFrame,
    lower: object = None,
    upper: object = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    rows = _chosen(rows_all_expenses(expenses), "category", categories)
    return largest_first(_between_days(rows, "posted_date", lower, upper), "posted_date")


def top_expenses_ranked(top: DataFrame) -> DataFrame:
    """The stored ranking in its reading order, largest spend first."""
    return largest_first(top, "total_spend")


# Daily and monthly --------------------------------------------------------


def chart_daily_overunder(overunder: DataFrame, expenses: DataFrame) -> DataFrame:
    """The daily mart from the first expense on."""
    first = expenses.agg(F.min(F.col("posted_at_timestamp").cast("date"))).scalar()
    return overunder.where(F.col("calendar_date") >= first)


def chart_monthly_savings(savings: DataFrame) -> DataFrame:
    """Savings with a ``yyyy|mm`` label; the balance is spend plus earned."""
    month = F.col("year_month")
    label = F.concat_ws(
        "|", F.year(month).cast("string"), F.lpad(F.month(month).cast("string"), 2, "0")
    )
    return savings.select(
        label.alias("year_month"),
        "total_spend",
        "total_earned",
        F.round(F.col("total_spend") + F.col("total_earned"), 2)
        .cast("decimal(38,2)")
        .alias("account_balance"),
        "dollars_saved",
        "pcnt_saved",
        "dollars_lost",
        "pcnt_lost",
    ).orderBy("year_month")


def rows_monthly_savings(savings: DataFrame) -> DataFrame:
    return savings.orderBy("year_month")


def savings_bounds(savings: DataFrame) -> DataFrame:
    month = F.col("year_month")
    bounds = savings.agg(F.min(month).alias("start_month"), F.max(month).alias("last"))
    return bounds.select(
        "start_month",
        month_span(F.col("start_month"), F.col("last")).cast("bigint").alias("month_span"),
    )


def total_saved(savings: DataFrame) -> DataFrame:
    return savings.agg(F.sum("dollars_saved").cast("decimal(38,2)").alias("savings"))


def savings_cutoff_month(savings: DataFrame, months: int) -> DataFrame:
    first = savings.agg(F.min("year_month").alias("first"))
    return first.select(F.add_months("first", months).alias("savings_as_of"))


# Income -------------------------------------------------------------------


def rows_income(
    income: DataFrame, as_of: AsOf = None, months: int = TRAILING_MONTHS
) -> DataFrame:
    recent = income.where(trailing_months(F.col("posted_at_timestamp"), months, as_of))
    return largest_first(
        recent.select(
            _posted_date(),
            "amount_earned",
            F.col("txn_description").alias("income_source"),
            F.concat(
                "merchant_category", F.lit(" | "), "merchant_subcategory"
            ).alias("income_type"),
        ),
        "posted_date",
    )


def unique_inc_types(income: DataFrame, as_of: AsOf = None) -> DataFrame:
    return rows_income(income, as_of).select("income_type").distinct()


def flt_rows_all_income(
    income: DataFrame, types: Sequence[str] | None = None, as_of: AsOf = None
) -> DataFrame:
    return largest_first(_chosen(rows_income(income, as_of), "income_type", types), "posted_date")
