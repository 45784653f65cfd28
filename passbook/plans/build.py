"""Build every table under a data root, from raw snapshots to marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from passbook.functions.calendar import AsOf
from passbook.operators import quality
from passbook.operators.lookup import small
from passbook.operators.quality import ERROR, WARN, Check
from passbook.plans import marts, star
from passbook.session import configure, scratch_path
from passbook.sources.defaults import CALENDAR_END, CALENDAR_START
from passbook.sources.folders import remove_folder
from passbook.sources.seeds import merchant_catalog, pay_rates
from passbook.sources.snapshots import flatten_accounts, flatten_transactions, read_snapshots
from passbook.sources.tables import Release

# Files of these tables are sorted by time, which reports filter on.
CLUSTERED_BY = {
    "fact_transactions": ["posted_at_timestamp", "txn_id"],
    "rpt_expenses_detail": ["posted_at_timestamp", "txn_description", "account"],
    "rpt_income_detail": ["posted_at_timestamp", "txn_description", "account"],
}


def build_all(
    spark: SparkSession,
    root: str,
    regex_csv: str | None = None,
    regex_overlay_csv: str | None = None,
    payrate_csv: str | None = None,
    as_of: AsOf = None,
    calendar: tuple[str, str] = (CALENDAR_START, CALENDAR_END),
    snapshots: DataFrame | None = None,
    stores: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Write all tables in dependency order, publish them and return the check report.

    Readers see the new tables all at once, at the end; a build that breaks off leaves
    nothing behind.

    Each table is read back by its consumers, so none is computed twice and
    every later plan starts from columnar files.  ``stores`` are the current rows of
    a transaction store and an account store (``passbook.streaming``); with them no
    raw file is read.  Else raw documents are parsed once, into a Parquet copy that
    both flattened forms read and that is removed at the end.
    """
    configure(spark)
    scratch: list[str] = []

    def staged(df: DataFrame, name: str) -> DataFrame:
        scratch.append(scratch_path(spark, name))
        df.write.parquet(scratch[-1])
        return spark.read.schema(df.schema).parquet(scratch[-1])

    try:
        with Release(spark, root) as release:

            def store(table: str, df: DataFrame) -> DataFrame:
                watch = list(NOT_NULL.get(table, ())) if table in WATCHED else None
                return release.write(df, table, CLUSTERED_BY.get(table), watch, star.derived_columns(table))

            if stores is None:
                raw = read_snapshots(spark, root) if snapshots is None else snapshots
                raw = staged(raw, "bronze")
                stores = flatten_transactions(raw), flatten_accounts(raw)
            flat_transactions, flat_accounts = stores
            catalog = store(
                "map_merchant_category_regex",
                merchant_catalog(spark, regex_csv, regex_overlay_csv),
            )
            rates = store("stg_payrate", pay_rates(spark, payrate_csv))
            accounts = store("dim_accounts", star.accounts_from_flat(flat_accounts))
            latest = star.latest_of_stored(flat_transactions, staged)
            fact = store("fact_transactions", star.as_fact(latest))
            days = store("dim_date", star.dim_date(spark, *calendar))
            pay = store("fact_daily_pay", star.fact_daily_pay(days, rates, as_of))
            merchants = store("dim_merchant", star.dim_merchant(fact, catalog))

            # One collapse and one join of the fact serve all three detail marts.
            labelled = marts.labelled_transactions(fact, small(merchants), staged).select(*marts.LABELLED)
            labelled = staged(labelled.sortWithinPartitions(*marts.LIKE_TEXTS), "labelled-transactions")
            expenses = store("rpt_expenses_detail", marts.expenses_of(labelled))
            income = store("rpt_income_detail", marts.income_of(labelled))
            unknown = store("rpt_unknown_transactions", marts.unknown_of(labelled))
            overunder = store("rpt_daily_overunder", marts.rpt_daily_overunder(expenses, pay))
            store("rpt_monthly_savings", marts.rpt_monthly_savings(expenses, income))
            store("rpt_mom_performance", marts.rpt_mom_performance(fact, overunder, as_of))
            top = store("rpt_top_expenses", marts.rpt_top_expenses(merchants))
            release.publish()
            counts = release.counts
    finally:
        for path in scratch:
            remove_folder(spark, path)

    tables = {
        "map_merchant_category_regex": catalog,
        "stg_payrate": rates,
        "dim_accounts": accounts,
        "fact_transactions": fact,
        "fact_daily_pay": pay,
        "dim_merchant": merchants,
        "rpt_unknown_transactions": unknown,
        "rpt_top_expenses": top,
    }
    return check_tables(tables, counts)


# Columns that must not be NULL, with the severity of a failure.
NOT_NULL = {
    "map_merchant_category_regex": {
        "merchant_category": WARN,
        "merchant_subcategory": ERROR,
        "regex_match_pat": ERROR,
        "match_priority": ERROR,
    },
    "stg_payrate": {
        "employer_name": ERROR,
        "biweekly_paycheck_posttax_amount": ERROR,
        "effective_start_date": ERROR,
        "effective_end_date": ERROR,
    },
    "dim_accounts": {
        "bank_account_id": WARN,
        "actual_balance": WARN,
        "available_balance": WARN,
        "balance_as_of_timestamp": WARN,
    },
    "fact_transactions": {"bank_account_id": ERROR, "txn_id": ERROR},
    "dim_merchant": {
        "merchant_category_key": ERROR,
        "merchant_name": WARN,
        "merchant_category": WARN,
        "merchant_subcategory": WARN,
    },
    "rpt_top_expenses": {
        "merchant_name": ERROR,
        "avg_spend_per_txn": WARN,
        "total_spend": WARN,
    },
}

# Columns that must be unique, with the severity of a failure.
UNIQUE = {
    "map_merchant_category_regex": ("merchant_subcategory", ERROR),
    "dim_accounts": ("bank_account_id", ERROR),
    "fact_transactions": ("txn_id", ERROR),
    "fact_daily_pay": ("calendar_date", WARN),
}


# Tables whose checks need counts of rows or NULLs, taken while they are written.
WATCHED = {*NOT_NULL, "rpt_unknown_transactions"}


def check_tables(
    tables: dict[str, DataFrame], counts: dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """The standing checks of the built tables, one row each.

    ``counts`` are rows and NULLs seen while the tables were written; without them every
    table is scanned once more for its NULLs.
    """
    uniques = {
        f"unique {table}.{column}": (tables[table], column, severity)
        for table, (column, severity) in UNIQUE.items()
    }
    key = "merchant_category_key"
    unparented = quality.orphans(
        tables["fact_transactions"], key, tables["dim_merchant"], key
    )
    orphaned = Check(f"relationship fact_transactions.{key}", unparented, WARN)
    unknown = "no unknown merchants"
    if counts is None:
        rest = [quality.run_checks([Check(unknown, tables["rpt_unknown_transactions"], WARN)])]
        rest += [
            quality.null_checks(table, tables[table], severities)
            for table, severities in NOT_NULL.items()
        ]
    else:
        told = {
            f"not_null {table}.{column}": (severity, counts[table][column])
            for table, severities in NOT_NULL.items()
            for column, severity in severities.items()
        }
        told[unknown] = (WARN, counts["rpt_unknown_transactions"][quality.ROWS])
        rest = [quality.told_checks(tables["fact_transactions"].sparkSession, told)]
    every = [quality.unique_checks(uniques), quality.run_checks([orphaned]), *rest]
    return reduce(DataFrame.unionByName, every)
