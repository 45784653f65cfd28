"""The built tables brought up to date after late or changed transactions.

A build reads every snapshot.  A refresh reads the transactions that arrived, finds what
they change, and takes the rest of each table over as it is:

- the merchants of old and new versions of a changed transaction, and, when the newest
  posting moves, those with a posting in the year that the period sums look back on;
- the detail rows of these merchants, whose net sign or category may have turned;
- the days and months whose sums over these rows differ from before.

All tables are published together; those that no transaction can change stay where they
are.  The catalog, the pay rates and the calendar must be those of the build.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.functions.calendar import AsOf
from passbook.functions.text import merchant_key
from passbook.operators.latest import Staged, marked_apart, matches_apart, may_match, repeated_hashes
from passbook.operators.lookup import is_small, small
from passbook.operators.periods import PERIODS
from passbook.plans import marts, star
from passbook.plans.build import CLUSTERED_BY
from passbook.schemas import FLAT_TRANSACTION
from passbook.session import configure, scratch_path
from passbook.sources.folders import remove_folder
from passbook.sources.tables import Release, read_table

KEY = "merchant_category_key"


def _matched(rows: DataFrame, keys: DataFrame, on: Column | str, name: str, how: str) -> DataFrame:
    """Semi or anti join of ``rows`` to ``keys`` where a NULL meets a NULL."""
    wanted = keys.select(F.col(name).alias("_wanted")).distinct()
    value = F.col(on) if isinstance(on, str) else on
    return rows.join(wanted, value.eqNullSafe(F.col("_wanted")), how)


def _digest(names: list[str]) -> Column:
    """128 bits of a row's values; NULLs count, as a hash of columns passes over them."""
    parts = [F.col(name) for name in names] + [F.col(name).isNull() for name in names]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def judged_arrivals(fact: DataFrame, arrived: DataFrame, staged: Staged | None = None) -> DataFrame:
    """Arrived rows, one per id, that are not stored as they are; ``is_new`` if their id is not.

    Of the fact only ids and digests are shuffled.  A row without id is never called new.
    With ``staged`` hashes of the ids tell which rows on both sides may share an id, and
    only these meet; both tables are then read three times and should be stored ones.
    """
    names = FLAT_TRANSACTION.names
    arrived, unmet = arrived.select(*names), None
    if staged is not None:
        shared = repeated_hashes([fact, arrived], ["txn_id"], staged)
        unmet, arrived = marked_apart(arrived, "txn_id", shared, staged)
        fact = marked_apart(fact, "txn_id", shared, staged)[1]
    known = fact.select(F.col("txn_id").alias("_id"), _digest(names).alias("_stored"))
    met = star.latest_transactions(arrived).join(known, F.col("txn_id") == F.col("_id"), "left")
    is_new = F.col("txn_id").isNotNull() & F.col("_id").isNull()
    same = F.coalesce(F.col("_stored") == _digest(names), F.lit(False))
    judged = met.where(~same).select(*names, is_new.alias("is_new"))
    if unmet is None:
        return judged
    return judged.unionByName(unmet.withColumn("is_new", F.col("txn_id").isNotNull()))


def corrected_transactions(fact: DataFrame, judged: DataFrame, staged: Staged | None = None) -> DataFrame:
    """The judged rows that take the place of a stored one of their id.

    With ``staged`` hardly any other row of the fact is shuffled to meet them.
    """
    names = FLAT_TRANSACTION.names
    contested = judged.where(~F.col("is_new")).select(*names)
    if staged is None:
        stored = _matched(fact, contested, "txn_id", "txn_id", "left_semi")
    else:
        stored = may_match(fact, "txn_id", contested, staged)
    # Of rows that are alike the stored one wins, and what a stored row wins is no correction.
    both = stored.select(*names, F.lit(1).alias("is_stored")).unionByName(
        contested.withColumn("is_stored", F.lit(0))
    )
    return star.latest_transactions(both, "is_stored").where("is_stored = 0").drop("is_stored")


def _differing(before: DataFrame, after: DataFrame, amount: str, step: Column) -> DataFrame:
    """Values of ``step`` at which the sum or the number of rows differs."""
    signed = before.select(step.alias("at"), (-F.col(amount)).alias("v"), F.lit(-1).alias("n")).unionByName(
        after.select(step.alias("at"), F.col(amount).alias("v"), F.lit(1).alias("n"))
    )
    summed = signed.groupBy("at").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    return summed.where("v <> 0 OR n <> 0").select("at")


def refresh_all(spark: SparkSession, root: str, arrived: DataFrame, as_of: AsOf = None) -> dict[str, int]:
    """Publish all tables as a build of everything would; returns how much was redone.

    ``arrived`` are flattened transactions, new, changed or known already.  They are read
    three times and should be a stored table.
    """
    configure(spark)
    scratch: list[str] = []

    def staged(df: DataFrame, name: str) -> DataFrame:
        scratch.append(scratch_path(spark, name))
        df.write.parquet(scratch[-1])
        return spark.read.schema(df.schema).parquet(scratch[-1])

    def stored(name: str) -> DataFrame:
        return read_table(spark, root, name)

    try:
        with Release(spark, root) as release:

            def store(table: str, df: DataFrame) -> DataFrame:
                return release.write(df, table, CLUSTERED_BY.get(table), derived=star.derived_columns(table))

            fact, merchants = stored("fact_transactions"), stored("dim_merchant")
            judged = staged(judged_arrivals(fact, arrived, staged), "judged")
            corrected = staged(corrected_transactions(fact, judged, staged), "corrected")
            fresh_rows = judged.where("is_new").drop("is_new")
            changed = staged(star.as_fact(fresh_rows.unionByName(corrected)), "changed")
            # New ids replace nothing: the fact meets the corrections alone.
            ids = small(corrected.select("txn_id"))
            others, near = matches_apart(fact, "txn_id", ids, staged)
            replaced = _matched(near, ids, "txn_id", "txn_id", "left_semi")
            kept = others.unionByName(_matched(near, ids, "txn_id", "txn_id", "left_anti"))
            fact_now = store("fact_transactions", kept.unionByName(changed))

            # Period sums end at the newest posting, so all that look back on it move.
            newest = F.max("posted_at_timestamp")
            before, now = fact.agg(newest).first()[0], fact_now.agg(newest).first()[0]
            keys = changed.select(KEY).unionByName(replaced.select(KEY))
            if before is not None and now != before:
                year_ago = F.lit(before) - F.expr(PERIODS["year"])
                keys = keys.unionByName(merchants.where(F.col("latest_txn_at") >= year_ago).select(KEY))
            keys = staged(keys.distinct(), "merchants")
            few = is_small(keys)
            keys = F.broadcast(keys) if few else keys
            # The key follows from payee and description, and its readers take it anew.
            touched = _matched(fact_now, keys, KEY, KEY, "left_semi").drop(KEY)
            # Where its rows are not shuffled to find it, reading it twice beats storing it.
            touched = touched if few else staged(touched, "touched")
            catalog = stored("map_merchant_category_regex")
            fresh = staged(star.dim_merchant(touched, catalog, newest=F.lit(now)), "fresh-merchants")
            merchants_now = store(
                "dim_merchant", _matched(merchants, keys, KEY, KEY, "left_anti").unionByName(fresh)
            )

            labelled = marts.labelled_transactions(touched, small(fresh), staged).select(*marts.LABELLED)
            labelled = staged(labelled.sortWithinPartitions(*marts.LIKE_TEXTS), "labelled")
            differing = {}
            details = {}
            for table, rows, payee, amount in (
                ("rpt_expenses_detail", marts.expenses_of(labelled), "merchant", "amount_spent"),
                ("rpt_income_detail", marts.income_of(labelled), "merchant", "amount_earned"),
                ("rpt_unknown_transactions", marts.unknown_of(labelled), "payee", "amount"),
            ):
                key = merchant_key(F.col(payee), F.col("txn_description"))
                rest = _matched(stored(table), keys, key, KEY, "left_anti")
                details[table] = store(table, rest.unionByName(rows))
                # The rest is in both and cancels out, so the old rows need not be found by their keys.
                day = F.col("posted_at_timestamp").cast("date")
                days = _differing(stored(table), details[table], amount, day)
                differing[table] = staged(days, f"days-{table}")

            expenses, income = details["rpt_expenses_detail"], details["rpt_income_detail"]
            days = small(differing["rpt_expenses_detail"])
            day = F.col("posted_at_timestamp").cast("date")
            pay = stored("fact_daily_pay")
            overunder = stored("rpt_daily_overunder")
            redone = marts.rpt_daily_overunder(
                _matched(expenses, days, day, "at", "left_semi"),
                _matched(pay, days, "calendar_date", "at", "left_semi"),
            )
            overunder_now = store(
                "rpt_daily_overunder",
                _matched(overunder, days, "calendar_date", "at", "left_anti").unionByName(redone),
            )

            months = days.unionByName(differing["rpt_income_detail"])
            months = small(staged(months.select(F.trunc("at", "month").alias("at")).distinct(), "months"))
            month = F.trunc(day, "month")
            savings = marts.rpt_monthly_savings(
                _matched(expenses, months, month, "at", "left_semi"),
                _matched(income, months, month, "at", "left_semi"),
            )
            others = _matched(stored("rpt_monthly_savings"), months, "year_month", "at", "left_anti")
            store("rpt_monthly_savings", others.unionByName(savings))
            # One row per month and one per merchant, from tables that are up to date.
            store("rpt_mom_performance", marts.rpt_mom_performance(fact_now, overunder_now, as_of))
            store("rpt_top_expenses", marts.rpt_top_expenses(merchants_now))
            redone_counts = {
                "transactions": changed.count(),
                "merchants": keys.count(),
                "days": days.count(),
                "months": months.count(),
            }
            release.publish()
            return redone_counts
    finally:
        for path in scratch:
            remove_folder(spark, path)
