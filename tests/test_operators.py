"""Lookup, quality, catalog, history and arrivals."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from passbook.operators import quality
from passbook.operators.lookup import salted_lookup
from passbook.operators.quality import WARN, Check, QualityError
from passbook.plans import arrivals, catalog, history, star
from passbook.plans.build import check_tables
from passbook.sources.snapshots import flatten_transactions
from tests.rows import at, epoch, fact, flat_row


# Lookup -------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_a_plain_join(spark, how):
    # One key holds a third of the rows, some keys have no lookup row.
    rows = spark.range(9000).select(
        F.col("id").cast("string").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 97 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("k"),
    )
    lookup = (
        rows.where("k is not null and k <> 'k7'")
        .groupBy("k")
        .agg(F.count("*").alias("n"), F.min("row_id").alias("label"))
    )
    got = salted_lookup(
        rows, lookup, ["k"], weight="n", spread="row_id", how=how, min_piece=100
    )
    want = rows.join(lookup.drop("n"), "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_key_is_spread_over_salts(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("row_id"), F.lit("hot").alias("k")
    )
    lookup = rows.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_lookup(
            rows, lookup, ["k"], weight="n", spread="row_id", min_piece=50
        )
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 3000
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2400

# Quality ------------------------------------------------------------------


def test_checks_and_severities(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, v string")
    parent = spark.createDataFrame([("a",)], "v string")
    assert [tuple(r) for r in quality.duplicated(df, "k").collect()] == [(1, 2)]
    assert {tuple(r) for r in quality.null_counts(df, ["k", "v"]).collect()} == {("k", 1), ("v", 1)}
    assert [tuple(r) for r in quality.orphans(df, "v", parent, "v").collect()] == [("b", 1)]
    report = quality.run_checks(
        [
            Check("unique k", quality.duplicated(df, "k"), WARN),
            Check("no orphans", quality.orphans(df, "v", parent, "v")),
            Check("parents unique", quality.duplicated(parent, "v")),
        ]
    )
    status = {r.check_name: (r.n_failures, r.status) for r in report.collect()}
    assert status == {
        "unique k": (1, "warn"),
        "no orphans": (1, "fail"),
        "parents unique": (0, "pass"),
    }
    with pytest.raises(QualityError, match="no orphans"):
        quality.raise_on_errors(report)
    passing = report.where("status <> 'fail'")
    assert quality.raise_on_errors(passing) is passing
    assert quality.is_empty(parent.where("v = 'z'")) and not quality.is_empty(parent)


def test_standing_checks_cover_the_contract_tests(spark):
    from passbook.schemas import CONTRACTS

    empty = {name: spark.createDataFrame([], schema) for name, schema in CONTRACTS.items()}
    rows = {r.check_name: r for r in check_tables(empty).collect()}
    assert len(rows) == 27 and {r.status for r in rows.values()} == {"pass"}
    assert rows["unique fact_transactions.txn_id"].severity == "error"
    assert rows["relationship fact_transactions.merchant_category_key"].severity == "warn"
    assert rows["not_null dim_merchant.merchant_name"].severity == "warn"
    assert rows["not_null fact_transactions.txn_id"].severity == "error"


def test_coverage_can_be_required(spark):
    merchants = spark.createDataFrame(
        [("k1", "food", 2), ("k2", "**UNKNOWN**", 3)],
        "merchant_category_key string, merchant_category string, total_transactions bigint",
    )
    known = merchants.where("merchant_category = 'food'")
    assert quality.require_coverage(known, "**UNKNOWN**") is known
    with pytest.raises(QualityError, match="1 merchant"):
        quality.require_coverage(merchants, "**UNKNOWN**")


# Catalog ------------------------------------------------------------------


def test_catalog_from_merchants(spark):
    merchants = spark.createDataFrame(
        [
            ("food", "grocery", "market", None),
            ("food", "grocery", "aldi", 5),
            ("food", "grocery", "market", None),
            ("travel", "air", "jet", None),
        ],
        "category string, subcategory string, token string, priority int",
    )
    extra = spark.createDataFrame(
        [("fees", "intl", "intl (fee|txn)", 1)],
        "category string, subcategory string, regex string, priority int",
    )
    rows = [tuple(r) for r in catalog.build_catalog(merchants, extra).collect()]
    assert rows == [
        ("fees", "intl", "^.*(intl (fee|txn)).*$", 1),
        ("food", "grocery", "^.*(aldi|market).*$", 5),
        ("travel", "air", "^.*(jet).*$", 10),
    ]


def test_catalog_keeps_null_groups_whole(spark):
    merchants = spark.range(10_001).select(
        F.lit("food").alias("category"),
        F.lit(None).cast("string").alias("subcategory"),
        F.concat(F.lit("t"), "id").alias("token"),
        F.lit(None).cast("int").alias("priority"),
    )
    (row,) = catalog.build_catalog(merchants).collect()
    assert row.regex_match_pat.count("|") == 10_000 and row.merchant_subcategory is None


def test_catalog_rules(spark):
    merchants = spark.createDataFrame(
        [("a", "vice", 1, 2), ("a", "travel", 3, 2), ("b|c", "spaceflight", 1, 1)],
        "token string, category string, amount_min int, amount_max int",
    )
    references = spark.createDataFrame([("a",), ("zz",)], "token string")
    report = quality.run_checks(catalog.catalog_checks(merchants, references))
    assert {r.check_name: r.status for r in report.collect()} == {
        "duplicate_token": "warn",
        "token_with_metacharacter": "fail",
        "category_outside_taxonomy": "warn",
        "amount_min_above_max": "fail",
        "dangling_reference": "fail",
    }


# History ------------------------------------------------------------------

MOVES = [
    ("1", "2026-01-01T00:00:00", "1.00"),
    ("2", "2026-02-28T12:00:00", "2.00"),
    ("3", "2026-03-01T00:00:00", "4.00"),
    ("4", "2026-03-01T00:00:01", "8.00"),
    ("5", "2026-03-31T00:00:00", "16.00"),
    ("6", "2026-03-31T09:00:00", "32.00"),
    ("7", "2025-10-01T00:00:00", "64.00"),
]


def test_balances_equal_a_sum_per_date(spark):
    rows = [flat_row(i, t, a) for i, t, a in MOVES] + [
        flat_row("8", "2026-03-30T00:00:00", "-5.00", account="Other")
    ]
    ledger = fact(spark, rows).withColumnRenamed("bank_account_name", "account")
    accounts = spark.createDataFrame(
        [("Checking", Decimal("1000.00")), ("Other", Decimal("0.00")), ("Idle", Decimal("7.00"))],
        "account string, end_balance decimal(14,2)",
    )
    got = history.balances_as_of(accounts, ledger, "2026-03-31", "2026-01-15", 30)
    dates = history.as_of_dates("2026-03-31", "2026-01-15", 30)
    assert dates == [dt.date(2026, 3, 31), dt.date(2026, 3, 1), dt.date(2026, 1, 30)]
    want = set()
    for name, end in [("Checking", 1000), ("Other", 0), ("Idle", 7)]:
        for date in dates:
            cut = at(f"{date}T00:00:00")
            later = sum(
                r[5] for r in rows if r[1] == name and r[6] > cut
            )
            want.add((name, date, Decimal(end) - later))
    assert {tuple(r) for r in got.collect()} == want


def test_trailing_snapshots_hold_every_row_of_their_window(spark, monkeypatch):
    rows = [flat_row(i, t, a) for i, t, a in MOVES]
    rows += [flat_row("n1", "2026-03-30T00:00:00", "1.00", account=None)]
    f = fact(spark, rows)
    dates = ("2026-03-31", "2026-01-15", 30)
    want = sorted(
        (date, r[2])
        for date in history.as_of_dates(*dates)
        for r in rows
        if 0 <= (date - r[6].date()).days <= 88
    )
    placed = history.trailing_rows(f, *dates).collect()
    assert sorted((r.as_of_date, r.txn_id) for r in placed) == want
    for date, name in {(r.as_of_date, r.bank_account_name) for r in placed}:
        mine = sorted(
            (r.position, r.posted_at_timestamp)
            for r in placed
            if (r.as_of_date, r.bank_account_name) == (date, name)
        )
        assert [k for k, _ in mine] == list(range(1, len(mine) + 1))
        assert [t for _, t in mine] == sorted((t for _, t in mine), reverse=True)
    nested = history.trailing_snapshots(f, *dates)
    monkeypatch.setattr(history, "LIST_ROWS", 2)
    parts = history.trailing_snapshots(f, *dates).collect()
    assert max(len(r.transactions) for r in parts) == 2
    assert sum(len(r.transactions) for r in parts) == len(want)
    for row in nested.collect():
        posted = [t.posted for t in row.transactions]
        assert posted == sorted(posted, reverse=True)
    # The documents read back as the same transactions, and every account is there.
    balances = spark.createDataFrame(
        [(dt.date(2026, 3, 31), name, "i", Decimal("5.00"), None) for name in ("Checking", "Idle")],
        "as_of_date date, bank_account_name string, bank_account_id string,"
        " balance decimal(14,2), available_balance decimal(14,2)",
    )
    documents = history.snapshot_documents(nested, balances, "Bank").withColumn("filename", F.lit("f"))
    again = flatten_transactions(documents).select("txn_id", "amount").distinct()
    assert {r.txn_id for r in again.collect()} == {r[1] for r in want}
    newest = {r.bank_account_name: r.actual_balance for r in star.dim_accounts(documents).collect()}
    assert newest == {"Checking": Decimal("5.00"), "Idle": Decimal("5.00"), None: None}


def test_windows_reach_the_scan_as_a_range(spark, tmp_path):
    rows = [flat_row(i, t, a) for i, t, a in MOVES]
    fact(spark, rows).write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    moves = stored.withColumnRenamed("bank_account_name", "account")
    accounts = moves.select("account").distinct().withColumn("end_balance", F.lit(1))
    for df in (
        history.trailing_windows(stored, "2026-03-31", "2026-01-15", 30),
        history.balances_as_of(accounts, moves, "2026-03-31", "2026-01-15", 30),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan" in plan.split("PushedFilters", 1)[1]


# Arrivals -----------------------------------------------------------------


def test_freshness_from_name_and_content(spark):
    names = spark.createDataFrame(
        [("s3a://b/transactions/2026/03/01/2026-03-01T080000Z_bd1772300000.json",), ("x/other.json",)],
        "filename string",
    )
    rows = {r.filename[-12:]: r.balance_epoch for r in arrivals.freshness_from_names(names).collect()}
    assert rows == {"2300000.json": 1772300000, "x/other.json": None}
    recent = arrivals.stored_recently(
        arrivals.freshness_from_names(names), "2026-03-02 05:00:00"
    )
    assert recent.count() == 1
    stale = arrivals.stored_recently(
        arrivals.freshness_from_names(names), "2026-03-03 05:00:00"
    )
    assert stale.count() == 0
    docs = spark.createDataFrame(
        [("a", [(5,), (9,), (0,)]), ("b", []), ("c", None), ("d", [(None,)])],
        "filename string, accounts array<struct<`balance-date`: bigint>>",
    )
    got = {r.filename: (r.balance_epoch, r.n_accounts) for r in arrivals.freshness_from_content(docs).collect()}
    assert got == {"a": (9, 3), "b": (None, 0), "c": (None, 0), "d": (None, 1)}


def test_admission(spark):
    now = "2026-03-02 05:00:00"
    schema = "filename string, balance_epoch bigint, n_accounts int"
    yesterday = epoch("2026-03-01T23:00:00")
    candidates = spark.createDataFrame(
        [
            ("empty", None, 0),
            ("same", yesterday, 2),
            ("newer", yesterday + 60, 2),
            ("undated", None, 2),
        ],
        schema,
    )
    stored = spark.createDataFrame([("s", yesterday, 2)], schema)
    got = {r.filename: (r.decision, r.marker) for r in arrivals.admit(candidates, stored, now).collect()}
    assert got == {
        "empty": ("empty", None),
        "same": ("not_newer", None),
        "newer": ("new", yesterday + 60),
        "undated": ("new", epoch("2026-03-02T05:00:00")),
    }
    nothing = {r.decision for r in arrivals.admit(candidates, stored.limit(0), now).collect()}
    assert nothing == {"empty", "new"}
    today = spark.createDataFrame([("s", epoch("2026-03-02T01:00:00"), 2)], schema)
    assert {r.decision for r in arrivals.admit(candidates, today, now).collect()} == {"captured_today"}
