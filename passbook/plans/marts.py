"""The report marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.functions.calendar import AsOf, as_date, up_to_day_of_month, utinyint
from passbook.functions.money import (
    decimal_or_zero,
    double_to_decimal,
    flipped,
    mean_of_cents,
    ratio,
    rounded,
)
from passbook.functions.text import (
    BALANCE_TRANSFER_WORDS,
    EXPENSE_TRANSFER_WORDS,
    counts_as_spending,
    mentions,
    merchant_key,
)
from passbook.operators.contract import enforce_contract
from passbook.operators.latest import Staged, collapse_near_duplicates
from passbook.operators.lookup import salted_lookup
from passbook.operators.periods import PERIODS

# Fixed value: a day within this many dollars of its income is Grey.
GREY_BAND = 25

COLORS = ("green", "red", "grey", "black")

# What the three detail marts read of a labelled transaction.
LABELLED = (
    "posted_at_timestamp",
    "merchant_category",
    "merchant_subcategory",
    "merchant_total",
    "payee",
    "txn_description",
    "bank_account_name",
    "amount",
)

# Like texts side by side are stored best.
LIKE_TEXTS = ("txn_description", "payee")


def labelled_transactions(fact: DataFrame, merchants: DataFrame, staged: Staged | None = None) -> DataFrame:
    """Near duplicates collapsed, then the merchant's columns attached.

    The three detail marts are filters over this.  What they filter on is either
    a collapse key or fixed by one, so collapsing first gives the same rows, and
    Catalyst still moves the filters below the collapse and the join.  The merchant
    key, a digest of two collapse keys, is taken anew after the collapse: as text it
    would be a third of what the collapse shuffles.  ``staged`` is for a stored fact and
    keeps rows without a double out of the shuffle.
    """
    collapsed = collapse_near_duplicates(fact.drop("merchant_category_key"), staged)
    return salted_lookup(
        collapsed.withColumn(
            "merchant_category_key", merchant_key(F.col("payee"), F.col("txn_description"))
        ),
        merchants.select(
            "merchant_category_key",
            "merchant_category",
            "merchant_subcategory",
            F.col("total_amount").alias("merchant_total"),
            "total_transactions",
        ),
        ["merchant_category_key"],
        weight="total_transactions",
        spread="txn_id",
    )


def expenses_of(labelled: DataFrame) -> DataFrame:
    """Spending with merchants whose lifetime net is negative.

    Refunds of such a merchant show as negative spending.
    """
    spending = counts_as_spending(F.col("txn_description"), EXPENSE_TRANSFER_WORDS)
    return enforce_contract(
        labelled.where((F.col("merchant_total") < 0) & spending).select(
            "posted_at_timestamp",
            "merchant_category",
            "merchant_subcategory",
            F.col("payee").alias("merchant"),
            "txn_description",
            F.col("bank_account_name").alias("account"),
            flipped(F.col("amount"), "decimal(18,2)").alias("amount_spent"),
        ),
        "rpt_expenses_detail",
    )


def income_of(labelled: DataFrame) -> DataFrame:
    """Money in, other than transfers."""
    transfers = mentions(F.col("merchant_category"), "transfer")
    return enforce_contract(
        labelled.where(~transfers & (F.col("amount") >= 0)).select(
            "posted_at_timestamp",
            "merchant_category",
            "merchant_subcategory",
            F.col("payee").alias("merchant"),
            "txn_description",
            F.col("bank_account_name").alias("account"),
            F.col("amount").alias("amount_earned"),
        ),
        "rpt_income_detail",
    )


def unknown_of(labelled: DataFrame) -> DataFrame:
    """Transactions of merchants without a category."""
    return enforce_contract(
        labelled.where(mentions(F.col("merchant_category"), "unkn")).select(
            "amount",
            "posted_at_timestamp",
            "payee",
            "txn_description",
            "merchant_category",
        ),
        "rpt_unknown_transactions",
    )


def rpt_expenses_detail(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    return expenses_of(labelled_transactions(fact, merchants))


def rpt_income_detail(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    return income_of(labelled_transactions(fact, merchants))


def rpt_unknown_transactions(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    return unknown_of(labelled_transactions(fact, merchants))


def rpt_daily_overunder(expenses: DataFrame, daily_pay: DataFrame) -> DataFrame:
    """Income against spending per calendar day, with a colour.

    A NULL income or spend makes the difference NULL, so neither side of the
    balance shows it; nothing is coalesced before subtracting.
    """
    spent = expenses.groupBy(
        F.col("posted_at_timestamp").cast("date").alias("calendar_date")
    ).agg(F.sum("amount_spent").cast("decimal(38,2)").alias("spend"))
    days = spent.join(daily_pay, "calendar_date", "right")

    income, spend = F.col("daily_income"), F.col("spend")
    left_over = income - spend
    color = (
        F.when(F.coalesce(spend, F.lit(0)) == 0, "Green")
        .when(spend == income, "Black")
        .when(left_over > GREY_BAND, "Green")
        .when(left_over < -GREY_BAND, "Red")
        .when(left_over.between(-GREY_BAND, GREY_BAND), "Grey")
    )

    def signed(condition: Column) -> Column:
        return F.when(condition, left_over).otherwise(0).try_cast("decimal(12,2)")

    return enforce_contract(
        days.select(
            "calendar_date",
            F.coalesce(income, F.lit(0)).try_cast("decimal(12,2)").alias("daily_income"),
            F.coalesce(spend, F.lit(0)).try_cast("decimal(12,2)").alias("daily_spend"),
            signed(left_over > 0).alias("dollars_over"),
            signed(left_over < 0).alias("dollars_under"),
            color.alias("day_color"),
        ),
        "rpt_daily_overunder",
    )


def _by_month(detail: DataFrame, amount: str, total: str) -> DataFrame:
    month = F.trunc(F.col("posted_at_timestamp").cast("date"), "month")
    return detail.groupBy(month.alias("year_month")).agg(
        F.sum(amount).cast("decimal(38,2)").alias(total)
    )


def rpt_monthly_savings(
    expenses: DataFrame, income: DataFrame, corrected: bool = False
) -> DataFrame:
    """Totals of the months that have both spending and income.

    ``pcnt_lost`` repeats ``pcnt_saved``; ``corrected`` gives each fraction only
    in the months it describes.
    """
    months = _by_month(expenses, "amount_spent", "total_spend").join(
        _by_month(income, "amount_earned", "total_earned"), "year_month"
    )
    kept = F.col("total_earned") - F.col("total_spend")
    fraction = F.when(
        F.col("total_earned") > 0, ratio(kept, F.col("total_earned"))
    ).otherwise(0.0)
    saved = lost = fraction
    if corrected:
        saved = F.when(kept > 0, fraction).otherwise(0.0)
        lost = F.when(kept <= 0, fraction).otherwise(0.0)
    return enforce_contract(
        months.select(
            "year_month",
            "total_spend",
            "total_earned",
            decimal_or_zero(F.when(kept > 0, kept), "decimal(38,2)").alias("dollars_saved"),
            double_to_decimal(saved, 36, 4).alias("pcnt_saved"),
            decimal_or_zero(F.when(kept <= 0, kept), "decimal(38,2)").alias("dollars_lost"),
            double_to_decimal(lost, 36, 4).alias("pcnt_lost"),
        ),
        "rpt_monthly_savings",
    )


def rpt_mom_performance(
    fact: DataFrame, overunder: DataFrame, as_of: AsOf = None, corrected: bool = False
) -> DataFrame:
    """Each month so far against the month before, up to the same day of month.

    "Before" is the previous month present in the data.  Near duplicates are not
    collapsed in the balance.  The year is NULL unless ``corrected``.
    """
    posted, day = F.col("posted_at_timestamp"), F.col("calendar_date")
    balances = (
        fact.where(up_to_day_of_month(posted, as_of))
        .where(counts_as_spending(F.col("txn_description"), BALANCE_TRANSFER_WORDS))
        .groupBy(F.year(posted).alias("y"), F.month(posted).alias("m"))
        .agg(F.sum("amount").cast("decimal(38,2)").alias("balance"))
    )
    days = (
        overunder.where(up_to_day_of_month(day, as_of))
        .groupBy(F.year(day).alias("y"), F.month(day).alias("m"))
        .agg(
            mean_of_cents(F.sum("daily_spend"), F.count("daily_spend")).alias("spend"),
            *[
                F.count_if(F.col("day_color") == color.title()).alias(color)
                for color in COLORS
            ],
        )
    )
    # Monthly rows only: the unpartitioned window sorts one row per month.
    in_order = Window.orderBy("y", "m")
    measures = ["balance", "spend", *COLORS]
    months = balances.join(days, ["y", "m"], "left").withColumns(
        {f"last_{name}": F.lag(name).over(in_order) for name in measures}
    )

    def change(name: str) -> Column:
        delta = F.col(name) - F.col(f"last_{name}")
        whole = rounded(delta, 2) if name == "spend" else delta
        return whole.try_cast("decimal(12,2)")

    def relative(name: str) -> Column:
        delta = F.col(name) - F.col(f"last_{name}")
        share = ratio(delta, F.abs(F.col(f"last_{name}")))
        return rounded(share, 2).try_cast("decimal(14,4)")

    def dollars(name: str) -> Column:
        return F.col(name).try_cast("decimal(12,2)")

    def whole_dollars(name: str) -> Column:
        return F.round(F.col(name)).try_cast("decimal(12,2)")

    counts = [
        column
        for color in COLORS
        for column in (
            utinyint(F.col(color)).alias(f"total_{color}_days"),
            utinyint(F.col(f"last_{color}")).alias(f"last_month_total_{color}_days"),
            change(color).alias(f"mom_total_{color}_days_change"),
            relative(color).alias(f"pcnt_mom_total_{color}_days"),
        )
    ]
    year = F.col("y")
    return enforce_contract(
        months.select(
            as_date(as_of).alias("as_of_date"),
            (year.cast("smallint") if corrected else utinyint(year)).alias("year"),
            utinyint(F.col("m")).alias("month"),
            dollars("balance").alias("current_monthly_balance"),
            dollars("last_balance").alias("this_time_last_month_balance"),
            change("balance").alias("dollars_mom_balance_delta"),
            relative("balance").alias("pcnt_mom_balance_delta"),
            whole_dollars("spend").alias("avg_daily_spend"),
            whole_dollars("last_spend").alias("last_month_avg_daily_spend"),
            change("spend").alias("dollars_mom_avg_daily_spend_delta"),
            relative("spend").alias("pcnt_mom_avg_daily_spend_delta"),
            *counts,
        ),
        "rpt_mom_performance",
    )


def rpt_top_expenses(merchants: DataFrame, corrected: bool = False) -> DataFrame:
    """Net-negative merchants other than transfers, with the sign flipped.

    ``avg_spend_per_txn`` is transactions per dollar; ``corrected`` gives
    dollars per transaction.
    """
    total, count = F.col("total_amount"), F.col("total_transactions")
    if corrected:
        average = F.round(-total / count, 2).cast("decimal(38,2)")
    else:
        average = double_to_decimal(-ratio(count, total), 38, 2)
    spent = merchants.where((total < 0) & (F.col("merchant_category") != "transfers"))
    return enforce_contract(
        spent.select(
            "merchant_name",
            F.col("merchant_category").alias("category"),
            F.col("merchant_subcategory").alias("subcategory"),
            flipped(total, "decimal(38,2)").alias("total_spend"),
            *[
                flipped(F.col(f"amount_past_{name}"), "decimal(38,2)").alias(f"past_{name}")
                for name in PERIODS
            ],
            "earliest_txn_at",
            "latest_txn_at",
            "total_transactions",
            average.alias("avg_spend_per_txn"),
        ),
        "rpt_top_expenses",
    )
