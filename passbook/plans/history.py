"""Balances and snapshots as of earlier dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.operators.lookup import MIN_PIECE, PIECES
from passbook.operators.position import placed
from passbook.schemas import ORG

# Fixed value: days of history one snapshot covers.
WINDOW_DAYS = 88
DAY_SECONDS = 86_400
# Transactions in one nested list at most.
LIST_ROWS = 10_000
# What the place of a row in its snapshot depends on.
PLACED_BY = ("bank_account_name", "posted_at_timestamp", "txn_id")


def as_of_dates(as_of: str, start: str, every_days: int) -> list[dt.date]:
    """Every n-th day back from ``as_of``, not before ``start``, newest first."""
    newest, oldest = dt.date.fromisoformat(as_of), dt.date.fromisoformat(start)
    steps = (newest - oldest).days // every_days
    return [newest - dt.timedelta(days=every_days * step) for step in range(steps + 1)]


def _days_back(as_of: str, steps: Column, every_days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), steps * every_days)


def balances_as_of(
    accounts: DataFrame, ledger: DataFrame, as_of: str, start: str, every_days: int
) -> DataFrame:
    """Balance of every account at each as-of date: end balance minus later moves.

    A movement is later than step k and all steps before it in time, from the
    first k whose date it exceeds.  The ledger is summed per account and step,
    which combines map-side, and a running sum over the few steps finishes it;
    no row is paired with more than one date.

    ``accounts`` has account and end_balance; ``ledger`` account,
    posted_at_timestamp and amount.
    """
    dates = as_of_dates(as_of, start, every_days)
    steps = len(dates)
    newest = F.lit(as_of).cast("timestamp")
    age_seconds = F.unix_micros(newest) - F.unix_micros("posted_at_timestamp")
    step_micros = every_days * DAY_SECONDS * 1_000_000
    first_step = F.when(age_seconds < 0, F.lit(0)).otherwise(
        F.floor(age_seconds / F.lit(step_micros)) + 1
    )
    # Movements up to the oldest date count for none; the plain range reaches the scan.
    moved = (
        ledger.where(F.col("posted_at_timestamp") > F.lit(str(dates[-1])).cast("timestamp"))
        .withColumn("step", first_step.cast("int"))
        .where(F.col("step") < steps)
        .groupBy("account", "step")
        .agg(F.sum("amount").cast("decimal(38,2)").alias("moved"))
    )
    grid = accounts.select(
        "account",
        F.col("end_balance").cast("decimal(38,2)").alias("end_balance"),
        F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"),
    )
    # Peers of a step share its running sum, so asked-for steps and movements
    # meet in one window without a join.
    so_far = Window.partitionBy("account").orderBy("step")
    timeline = grid.withColumn("asked", F.lit(True)).unionByName(
        moved.withColumn("asked", F.lit(False)), allowMissingColumns=True
    )
    later = F.coalesce(F.sum("moved").over(so_far), F.lit(0))
    return (
        timeline.withColumn("balance", (F.col("end_balance") - later).cast("decimal(38,2)"))
        .where("asked")
        .select(
            "account",
            _days_back(as_of, F.col("step"), every_days).alias("as_of_date"),
            "balance",
        )
    )


def trailing_windows(
    ledger: DataFrame, as_of: str, start: str, every_days: int, window_days: int = WINDOW_DAYS
) -> DataFrame:
    """Each row once per snapshot whose window, ending on its date, holds it.

    The snapshots that hold a row follow from its date by arithmetic, so the
    range join becomes a short sequence per row.  The end day counts whole.
    """
    dates = as_of_dates(as_of, start, every_days)
    steps = len(dates)
    # No window holds a row outside this plain range, which reaches the scan.
    posted = F.col("posted_at_timestamp")
    first_day = dates[-1] - dt.timedelta(days=window_days)
    after_last = dates[0] + dt.timedelta(days=1)
    within = (posted >= F.lit(str(first_day)).cast("timestamp")) & (
        posted < F.lit(str(after_last)).cast("timestamp")
    )
    age = F.datediff(F.lit(as_of).cast("date"), F.col("posted_at_timestamp").cast("date"))
    # Snapshot k ends k * every_days before as_of: it holds ages from that to
    # window_days more; at midnight sharp the oldest day counts too.
    oldest = F.ceil((age - window_days) / F.lit(every_days))
    lowest = F.greatest(oldest, F.lit(0)).cast("int")
    highest = F.least(F.floor(age / F.lit(every_days)), F.lit(steps - 1)).cast("int")
    return (
        ledger.where(within)
        .withColumn("_low", lowest)
        .withColumn("_high", highest)
        .where(F.col("_low") <= F.col("_high"))
        .withColumn("_step", F.explode(F.sequence("_low", "_high")))
        .withColumn("as_of_date", _days_back(as_of, F.col("_step"), every_days))
        .drop("_low", "_high", "_step")
    )


def trailing_rows(
    fact: DataFrame,
    as_of: str,
    start: str,
    every_days: int,
    window_days: int = WINDOW_DAYS,
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """The rows of every snapshot with their ``position`` per date and account.

    Position 1 is the newest row, ties go by id.  The rows are range-sorted once, so an
    account, or one day of it, that holds much of all rows spreads over tasks.  Every
    column of ``fact`` is sorted and stored with its row; ``columns`` names those that the
    caller reads, beside the account, the time and the id.
    """
    if columns is not None:
        fact = fact.select(*dict.fromkeys([*PLACED_BY, *columns]))
    rows = trailing_windows(fact, as_of, start, every_days, window_days)
    newest = [F.col("posted_at_timestamp").desc(), F.col("txn_id").asc()]
    return placed(rows, ["as_of_date", "bank_account_name"], newest, "position")


def busy_accounts(rows: DataFrame, least: int | None = None) -> list[str | None]:
    """Names of accounts with more than 1/``PIECES`` of all rows and more than ``least`` rows.

    So there are fewer than ``PIECES``, however many rows there are.  ``least`` is
    ``MIN_PIECE`` by default.
    """
    counted = rows.groupBy("bank_account_name").agg(F.count(F.lit(1)).alias("n"))
    share = counted.agg(F.sum("n")).scalar() / F.lit(PIECES)
    busy = counted.where(F.col("n") > F.greatest(share, F.lit(MIN_PIECE if least is None else least)))
    return [row.bank_account_name for row in busy.collect()]


def trailing_snapshots(
    fact: DataFrame,
    as_of: str,
    start: str,
    every_days: int,
    window_days: int = WINDOW_DAYS,
    busy_rows: int | None = None,
) -> DataFrame:
    """Nested transactions per snapshot, account and ``part``, newest first.

    A part is ``LIST_ROWS`` successive positions of one account, numbered from 0, so no
    list outgrows a row however busy an account is.  The rows of an account meet in one
    task, each once, and unfold to its snapshots there; nothing is stored on the way.  Only
    those of ``busy_accounts`` (with more than ``busy_rows`` rows) are placed over many tasks.
    """
    columns = ("bank_account_id", "amount", "txn_description", "payee")
    dates = (as_of, start, every_days, window_days)
    fact = fact.select(*PLACED_BY, *columns)
    busy = busy_accounts(fact, busy_rows)
    quiet, loud = fact, fact.where(F.lit(False))
    if busy:
        names = fact.sparkSession.createDataFrame([(name,) for name in busy], "_busy string")
        same = F.col("bank_account_name").eqNullSafe(F.col("_busy"))
        quiet = fact.join(F.broadcast(names), same, "left_anti")
        loud = fact.join(F.broadcast(names), same, "left_semi")
    newest = Window.partitionBy("as_of_date", "bank_account_name").orderBy(
        F.col("posted_at_timestamp").desc(), F.col("txn_id").asc()
    )
    rows = trailing_windows(quiet.repartition("bank_account_name"), *dates)
    rows = rows.withColumn("position", F.row_number().over(newest).cast("long"))
    return _nested(rows).unionByName(_nested(trailing_rows(loud, *dates, columns)))


def _nested(rows: DataFrame) -> DataFrame:
    """The rows of a snapshot, account and ``part`` as one list in the order of their positions."""
    rows = rows.withColumn("part", F.floor((F.col("position") - 1) / LIST_ROWS))
    posted = F.unix_seconds("posted_at_timestamp")
    txn = F.struct(
        "position",
        F.col("txn_id").alias("id"),
        posted.alias("posted"),
        F.col("amount").cast("string").alias("amount"),
        F.col("txn_description").alias("description"),
        F.col("payee").alias("payee"),
    )
    ordered = F.sort_array(F.collect_list(txn))
    return rows.groupBy("as_of_date", "bank_account_name", "part").agg(
        F.max("bank_account_id").alias("bank_account_id"),
        F.transform(
            ordered,
            lambda t: F.struct(
                t.id.alias("id"),
                t.posted.alias("posted"),
                t.amount.alias("amount"),
                t.description.alias("description"),
                t.payee.alias("payee"),
                F.lit("").alias("memo"),
                t.posted.alias("transacted_at"),
                F.lit(None).cast("string").alias("mcc"),
            ),
        ).alias("transactions"),
    )


def snapshot_documents(
    snapshots: DataFrame, balances: DataFrame | None = None, org: str | None = None
) -> DataFrame:
    """The nested lists as snapshot documents, in the raw read schema.

    ``balances`` has as_of_date, bank_account_name, bank_account_id, balance and
    available_balance, one row per date and account.  Each of its rows is a
    document with the balances and no transactions, so accounts without any in the
    window are there too; the transactions follow in documents of one part of an
    account, which carry no balance.  Readers take both alike.
    """
    nothing = F.lit(None).cast("string")
    lists = snapshots.select(
        "as_of_date",
        "bank_account_name",
        "bank_account_id",
        nothing.alias("balance"),
        nothing.alias("available_balance"),
        F.lit(None).cast("timestamp").alias("balance_at"),
        "transactions",
    )
    if balances is not None:
        heads = balances.select(
            "as_of_date",
            "bank_account_name",
            "bank_account_id",
            F.col("balance").cast("string").alias("balance"),
            F.col("available_balance").cast("string").alias("available_balance"),
            F.col("as_of_date").cast("timestamp").alias("balance_at"),
            F.array().cast(snapshots.schema["transactions"].dataType).alias("transactions"),
        )
        lists = lists.unionByName(heads)
    else:
        lists = lists.withColumn("balance_at", F.col("as_of_date").cast("timestamp"))
    account = F.struct(
        F.col("bank_account_id").alias("id"),
        F.col("bank_account_name").alias("name"),
        F.lit("USD").alias("currency"),
        "balance",
        F.col("available_balance").alias("available-balance"),
        F.unix_timestamp("balance_at").alias("balance-date"),
        "transactions",
        F.array().cast("array<string>").alias("holdings"),
        F.struct(
            *[F.lit(org if f.name == "name" else None).cast("string").alias(f.name) for f in ORG.fields]
        ).alias("org"),
    )
    return lists.select(
        F.array().cast("array<string>").alias("errors"),
        F.array(account).alias("accounts"),
    )
