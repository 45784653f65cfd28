"""The whole build, and the physical plans it relies on."""

from __future__ import annotations

import pytest

from passbook.operators.quality import raise_on_errors
from passbook.plans import marts, reports, star
from passbook.operators import quality
from passbook.operators.categorize import UNKNOWN
from passbook.plans.build import NOT_NULL, build_all, check_tables
from passbook.plans.refresh import refresh_all
from passbook.schemas import CONTRACTS, FLAT_ACCOUNT
from passbook.sources.snapshots import read_snapshots
from passbook.sources.tables import read_table, unpublished
from tests.plan import plan_of
from tests.rows import account, flat, flat_row, txn, write_snapshot


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("root")
    early = [
        txn("1", "2026-01-05T10:00:00", "-120.00", "PIGGLY WIGGLY 12", "Piggly"),
        txn("2", "2026-01-06T10:00:00", "2000.00", "ACME PAYROLL", "Acme"),
        txn("3", "2026-01-07T10:00:00", "-50.00", "Transfer to Credit Card 9", "Bank"),
        txn("4", "2026-01-08T10:00:00", "-75.00", "Transfer To Savings", "Bank"),
    ]
    late = [
        txn("5", "2026-02-05T10:00:00", "-80.00", "NETFLIX.COM", "Netflix"),
        txn("6", "2026-02-06T10:00:00", "1900.00", "ACME PAYROLL", "Acme"),
        txn("7", "2026-02-07T10:00:00", "-10.00", "who knows", "Who"),
    ]
    write_snapshot(path, "2026-01-31T23:00:00", [account("Checking", "10.00", "2026-01-31T23:00:00", early)])
    write_snapshot(path, "2026-02-28T23:00:00", [account("Checking", "20.00", "2026-02-28T23:00:00", early + late)])
    overlay = path / "overlay.csv"
    overlay.write_text(
        "merchant_category,merchant_subcategory,regex_match_pat,match_priority\n"
        "payments,paycheck,^.*(acme payroll).*$,10\n"
    )
    report = build_all(
        spark,
        str(path),
        regex_overlay_csv=str(overlay),
        as_of="2026-02-28",
        calendar=("2026-01-01", "2027-01-01"),
    )
    return str(path), report


def test_every_table_is_stored_under_its_contract(spark, root):
    for table, contract in CONTRACTS.items():
        stored = read_table(spark, root[0], table)
        assert stored.schema == contract
        stored.collect()


def test_build_results(spark, root):
    def table(name):
        return read_table(spark, root[0], name)

    assert table("fact_transactions").count() == 7
    assert table("rpt_monthly_savings").count() == 2
    assert table("rpt_unknown_transactions").first().txn_description == "who knows"
    assert table("rpt_daily_overunder").count() == 59
    summary = quality.coverage_summary(table("dim_merchant"), UNKNOWN).first()
    assert (summary.unique_transactions, summary.merchant_keys, summary.unknown_keys) == (7, 6, 1)
    categories = {r.merchant_name: r.merchant_category for r in table("dim_merchant").collect()}
    assert categories["acme"] == "payments" and categories["piggly"] == "cost-of-living"


def test_build_report_warns_but_does_not_fail(root):
    report = raise_on_errors(root[1])
    status = {r.check_name: r.status for r in report.collect()}
    assert status["no unknown merchants"] == "warn"
    assert status["unique fact_transactions.txn_id"] == "pass"


LOAD_TIMES = {"record_loaded_at_timestamp", "record_updated_at", "filename"}
REFRESHED = (
    "fact_transactions", "dim_merchant", "rpt_expenses_detail", "rpt_income_detail", "rpt_unknown_transactions",
    "rpt_daily_overunder", "rpt_monthly_savings", "rpt_mom_performance", "rpt_top_expenses",
)


def contents(spark, root, name):
    df = read_table(spark, root, name)
    return sorted(map(str, df.drop(*LOAD_TIMES).collect()))


def test_refresh_equals_a_build_of_everything(spark, tmp_path):
    """A late refund turns a merchant's sign (K7); a posting moves; an id is known already."""
    first = [
        flat_row("1", "2026-01-05T10:00:00", "-20.00", "netflix one", "N"),
        flat_row("2", "2026-01-06T10:00:00", "-5.00", "target a", "T"),
        flat_row("3", "2026-01-07T10:00:00", "2000.00", "who knows", "W"),
        flat_row("4", "2026-02-07T10:00:00", "-75.00", "netflix one", "N"),
        flat_row("5", "2026-03-01T10:00:00", "-1.00", "costco", None),
        flat_row("6", "2024-01-01T10:00:00", "-9.00", "old costco", "C"),
    ]
    late = [
        flat_row("7", "2026-01-20T10:00:00", "500.00", "netflix one", "N"),
        flat_row("2", "2026-01-08T10:00:00", "-5.50", "target b", "T"),
        flat_row("3", "2026-01-07T10:00:00", "2000.00", "who knows", "W"),
    ]
    newer = [flat_row("8", "2026-03-09T10:00:00", "-3.00", "aldi", "A")]
    calendar = ("2024-01-01", "2026-04-01")
    accounts = spark.createDataFrame([], FLAT_ACCOUNT)

    def build(rows, name):
        root = str(tmp_path / name)
        build_all(spark, root, as_of="2026-03-31", calendar=calendar, stores=(flat(spark, rows), accounts))
        return root

    root = build(first, "first")
    redone = refresh_all(spark, root, flat(spark, late), "2026-03-31")
    assert redone == {"transactions": 2, "merchants": 3, "days": 4, "months": 2}
    whole = build(first + late, "whole")
    for name in REFRESHED:
        assert contents(spark, root, name) == contents(spark, whole, name), name
    # Nothing new: nothing is redone.
    assert set(refresh_all(spark, root, flat(spark, late), "2026-03-31").values()) == {0}
    # The newest posting moves: merchants without a posting in the year before stay.
    redone = refresh_all(spark, root, flat(spark, newer), "2026-03-31")
    whole = build(first + late + newer, "newer")
    assert redone["transactions"] == 1 and redone["merchants"] == 5
    assert read_table(spark, root, "dim_merchant").count() == 6
    for name in REFRESHED:
        assert contents(spark, root, name) == contents(spark, whole, name), name


def test_checks_of_the_write_equal_checks_by_scan(spark, root):
    tables = {name: read_table(spark, root[0], name) for name in CONTRACTS}
    scanned = check_tables(tables)
    told, want = ({tuple(r) for r in report.collect()} for report in (root[1], scanned))
    assert told == want and len(told) == 27
    scans = [plan_of(report).count("Location: InMemoryFileIndex") for report in (root[1], scanned)]
    assert scans[0] == 6 and scans[1] > scans[0] + len(NOT_NULL)


def test_a_build_that_breaks_off_changes_no_table(spark, root, monkeypatch):
    names = ("fact_transactions", "dim_merchant", "rpt_expenses_detail", "rpt_top_expenses")
    before = {name: read_table(spark, root[0], name).count() for name in names}

    def lost(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(marts, "rpt_top_expenses", lost)
    with pytest.raises(RuntimeError):
        build_all(spark, root[0], as_of="2026-02-20", snapshots=read_snapshots(spark, root[0]).limit(1))
    assert {name: read_table(spark, root[0], name).count() for name in names} == before
    assert unpublished(spark, root[0]) == []


def test_dedup_limits_groups_before_the_exchange(spark, root):
    fact = read_table(spark, root[0], "fact_transactions")
    plan = plan_of(star.latest_transactions(fact.drop("merchant_category_key", "record_loaded_at_timestamp")))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2  # one on each side of the exchange
    assert tree.count("Exchange") == 1


def test_marts_never_multiply_rows(spark, root):
    fact = read_table(spark, root[0], "fact_transactions")
    merchants = read_table(spark, root[0], "dim_merchant")
    days = read_table(spark, root[0], "dim_date")
    rates = read_table(spark, root[0], "stg_payrate")
    for df in (
        marts.rpt_expenses_detail(fact, merchants),
        marts.rpt_income_detail(fact, merchants),
        star.dim_merchant(fact, read_table(spark, root[0], "map_merchant_category_regex")),
        star.fact_daily_pay(days, rates, "2026-02-28"),
    ):
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        assert "Python" not in plan


def test_trailing_bounds_reach_the_scan(spark, root):
    expenses = read_table(spark, root[0], "rpt_expenses_detail")
    plan = plan_of(reports.rows_mortgage_payment(expenses, as_of="2026-02-28"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(posted_at_timestamp" in pushed
    assert "LessThan(posted_at_timestamp" in pushed
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "merchant_category" not in schema


def test_balance_scan_reads_two_columns(spark, root):
    accounts = read_table(spark, root[0], "dim_accounts")
    plan = plan_of(reports.total_checking(accounts))
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "bank_account_name" in schema and "actual_balance" in schema
    assert "filename" not in schema
