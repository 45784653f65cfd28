"""Snapshots, seeds, paths, tables and the spine."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from passbook import session
from passbook.operators.contract import ContractError, enforce_contract
from passbook.plans import arrivals, star
from passbook.schemas import CONTRACTS
from passbook.session import remove_scratch, scratch_path
from passbook.sources.folders import (
    MARKS,
    complete_folders,
    create_text,
    file_names,
    folder_exists,
    read_text,
    sub_folders,
)
from passbook.sources.paths import data_path, table_path
from passbook.sources.seeds import merchant_catalog, pay_rates
from passbook.sources.snapshots import list_files, read_snapshots
from passbook.sources.spine import date_spine
from passbook.sources.tables import Release, current_path, read_table, unpublished, write_table
from tests.plan import plan_of
from tests.rows import account, txn, write_snapshot


@pytest.fixture()
def root(tmp_path):
    shared = txn("t1", "2026-01-10T12:00:00", "-12.34", "corner shop", "Shop")
    write_snapshot(
        tmp_path,
        "2026-01-31T23:10:00",
        [
            account("Checking", "100.005", "2026-01-31T23:10:00", [shared]),
            account("Mortgage", "n/a", "2026-01-31T23:10:00", [], key="id-2"),
        ],
    )
    later = txn("t2", "2026-02-10T12:00:00", "50", None, None)
    newline = txn("t3", "2026-02-11T12:00:00", "-1.00", "first\nsecond shop", "Shop")
    write_snapshot(
        tmp_path,
        "2026-02-28T23:10:00",
        [account("Checking", "137.67", "2026-02-28T23:10:00", [newline, later, shared], key="id-9")],
    )
    write_snapshot(tmp_path, "2026-03-01T08:00:00", [])
    return str(tmp_path)


def test_fact_has_one_row_per_transaction(spark, root):
    rows = {r.txn_id: r for r in star.fact_transactions(read_snapshots(spark, root)).collect()}
    assert set(rows) == {"t1", "t2", "t3"}
    # Overlap: the newest file stands for the repeated transaction.
    assert rows["t1"].filename.endswith(".json") and "2026/02/28" in rows["t1"].filename
    assert rows["t1"].amount == Decimal("-12.34")
    assert rows["t2"].payee is None and rows["t2"].merchant_category_key is not None


def test_accounts_keep_the_newest_balance_per_name(spark, root):
    rows = {r.bank_account_name: r for r in star.dim_accounts(read_snapshots(spark, root)).collect()}
    assert set(rows) == {"Checking", "Mortgage"}
    assert rows["Checking"].bank_account_id == "id-9"
    assert rows["Checking"].actual_balance == Decimal("137.67")
    assert rows["Mortgage"].actual_balance is None  # safe cast


def test_listing_reads_no_content_and_only_the_days_asked_for(spark, tmp_path):
    for day in ("2026-01-30", "2026-01-31", "2026-02-01"):
        write_snapshot(tmp_path, f"{day}T00:00:00", [account("A", "1", f"{day}T00:00:00", [])])
    root = str(tmp_path)
    files = list_files(spark, root)
    plan = plan_of(files)
    assert files.count() == 3 and "content" not in plan.split("ReadSchema")[1].split("\n")[0]
    days = [dt.date(2026, 1, 31), dt.date(2026, 2, 1), dt.date(2030, 1, 1)]
    some = list_files(spark, root, days=days)
    assert {r.filename.split("/transactions/")[1][:10] for r in some.collect()} == {"2026/01/31", "2026/02/01"}
    assert list_files(spark, root, days=days[2:]).count() == 0
    recent = arrivals.stored_recently(arrivals.freshness_from_names(some), "2026-02-01 08:00:00")
    assert recent.count() == 2 and recent.where("balance_epoch IS NULL").count() == 0


def test_bad_amount_fails_the_fact(spark, tmp_path):
    bad = txn("t1", "2026-01-10T12:00:00", "12,00", "x", "y")
    write_snapshot(tmp_path, "2026-01-31T00:00:00", [account("A", "1", "2026-01-31T00:00:00", [bad])])
    with pytest.raises(PySparkException):
        star.fact_transactions(read_snapshots(spark, str(tmp_path))).collect()


def test_malformed_document_fails_the_read(spark, tmp_path):
    path = write_snapshot(tmp_path, "2026-01-31T00:00:00", [])
    path.write_text("{not json")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_snapshots(spark, str(tmp_path)).collect()


HEADER = "merchant_category,merchant_subcategory,regex_match_pat,match_priority\n"


def test_catalog_replacement_and_overlay(spark, tmp_path):
    one = tmp_path / "one.csv"
    one.write_text(HEADER + 'a,b,^.*(link\\.com|"").*$,10\n' + 'a,c,"x,""y"" \\*z",1\n')
    two = tmp_path / "two.csv"
    two.write_text(HEADER + "payments,paycheck,^.*(acme).*$,10\n")
    default = merchant_catalog(spark)
    assert default.count() == 56
    overlaid = merchant_catalog(spark, overlay=str(two))
    assert overlaid.count() == 57
    replaced = merchant_catalog(spark, replacement=str(one), overlay=str(two))
    rows = {r.merchant_subcategory: r for r in replaced.collect()}
    assert set(rows) == {"b", "c"}
    assert rows["b"].regex_match_pat.startswith("^.*(link\\.com|")
    assert rows["c"].regex_match_pat == 'x,"y" \\*z'
    assert replaced.schema == CONTRACTS["map_merchant_category_regex"]


def test_seed_casts_are_strict(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(HEADER + "a,b,c,ten\n")
    with pytest.raises(PySparkException):
        merchant_catalog(spark, replacement=str(path)).collect()


def test_pay_rates(spark, tmp_path):
    row = pay_rates(spark).first()
    assert row.biweekly_paycheck_posttax_amount == 0
    assert row.effective_end_date == dt.date(9999, 12, 31)
    path = tmp_path / "pay.csv"
    path.write_text(
        "employer_name,employer_address,biweekly_paycheck_posttax_amount,"
        "effective_start_date,effective_end_date\n"
        'Acme,"1 Lane, Town",1500.5,2026-01-01,9999-12-31\n'
    )
    row = pay_rates(spark, str(path)).first()
    assert row.employer_address == "1 Lane, Town"
    assert row.biweekly_paycheck_posttax_amount == Decimal("1500.50")


def test_paths_use_one_slash():
    assert data_path("s3a://bucket/", "/stage/x") == "s3a://bucket/stage/x"
    assert data_path("root", "x") == "root/x"
    assert table_path("r", "stg_payrate") == "r/stage/stg_payrate.parquet"
    assert table_path("r", "dim_date") == "r/dashboard_mart/kimball_star/dim_date.parquet"
    assert table_path("r", "rpt_top_expenses") == "r/dashboard_mart/rpt_top_expenses.parquet"


def test_table_round_trip_overwrites(spark, tmp_path):
    days = star.dim_date(spark, "2026-01-01", "2026-01-11")
    for _ in range(2):
        write_table(days, str(tmp_path), "dim_date", ["full_date", "date_week"])
    stored = read_table(spark, str(tmp_path), "dim_date")
    assert stored.count() == 10
    assert stored.schema == CONTRACTS["dim_date"]


def january(spark, days):
    return star.dim_date(spark, "2026-01-01", f"2026-01-{days + 1:02d}")


def test_a_write_that_breaks_off_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    write_table(january(spark, 10), root, "dim_date")
    before = read_table(spark, root, "dim_date")  # a reader that is under way
    broken = january(spark, 20).withColumn(
        "date_week", F.when(F.dayofmonth("full_date") == 15, F.raise_error(F.lit("lost"))).otherwise(F.col("date_week"))
    )
    broken = broken.withColumn("date_week", F.col("date_week").cast(CONTRACTS["dim_date"]["date_week"].dataType))
    for clustered in (None, ["full_date", "date_week"]):
        with pytest.raises(PySparkException):
            write_table(broken, root, "dim_date", clustered)
        assert read_table(spark, root, "dim_date").count() == 10 == before.count()
    assert unpublished(spark, root) == [] and len(sub_folders(spark, f"{root}/_releases")) == 1


def test_tables_of_a_release_appear_together(spark, tmp_path):
    root = str(tmp_path)
    write_table(january(spark, 10), root, "dim_date")
    rates = pay_rates(spark)
    with Release(spark, root) as release:
        release.write(january(spark, 20), "dim_date")
        release.write(rates, "stg_payrate")
        assert read_table(spark, root, "dim_date").count() == 10
        assert unpublished(spark, root) == [release.name]
        release.publish()
    assert read_table(spark, root, "dim_date").count() == 20
    assert read_table(spark, root, "stg_payrate").count() == 1
    with Release(spark, root) as release:  # given up: nothing changes
        release.write(january(spark, 5), "dim_date")
    assert read_table(spark, root, "dim_date").count() == 20 and unpublished(spark, root) == []


def test_releases_out_of_use_go_and_others_stay(spark, tmp_path):
    root = str(tmp_path)
    write_table(pay_rates(spark), root, "stg_payrate")
    kept = current_path(spark, root, "stg_payrate")
    for days in (3, 4, 5, 6):
        last = read_table(spark, root, "dim_date") if days > 3 else None
        write_table(january(spark, days), root, "dim_date")
        assert last is None or last.count() == days - 1  # the release before the newest
    assert len(sub_folders(spark, f"{root}/_releases")) == 3  # two of dim_date, one of stg_payrate
    assert current_path(spark, root, "stg_payrate") == kept and read_table(spark, root, "stg_payrate").count() == 1
    assert file_names(spark, f"{root}/_manifests", ".json") == ["000000000004.json", "000000000005.json"]


def test_folders_without_markers_are_not_trusted(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "s/one"))
    assert complete_folders(spark, str(tmp_path / "s")) == ["one"]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(MARKS, "false")
    try:
        with pytest.raises(RuntimeError, match="cannot be told"):
            complete_folders(spark, str(tmp_path / "s"))
    finally:
        conf.unset(MARKS)


def test_scratch_goes_with_the_application(spark, monkeypatch):
    path = scratch_path(spark, "left")
    spark.range(3).write.parquet(path)
    app = spark.sparkContext.applicationId
    assert not remove_scratch("another") and spark.read.parquet(path).count() == 3
    session._scratch["part"] = path
    monkeypatch.setattr(type(spark.sparkContext), "applicationId", "part")
    remove_scratch("part")
    assert not folder_exists(spark, path) and session._scratch[app] in path


def test_a_name_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "m/1.json")
    assert create_text(spark, path, "é") and not create_text(spark, path, "b")
    assert read_text(spark, path) == "é" and file_names(spark, str(tmp_path / "m"), ".json") == ["1.json"]


def test_contract_names_every_problem(spark):
    days = star.dim_date(spark, "2026-01-01", "2026-01-02")
    wrong = days.drop("date_week").withColumn("extra", F.lit(1)).withColumn(
        "full_date", F.col("full_date").cast("string")
    )
    with pytest.raises(ContractError) as error:
        enforce_contract(wrong, "dim_date")
    text = str(error.value)
    assert "missing column date_week" in text
    assert "unexpected column extra" in text
    assert "full_date is string, not date" in text


def test_default_calendar(spark):
    assert star.dim_date(spark).count() == 27027
    assert date_spine(spark, "2026-01-05", "2026-01-05").count() == 0
    row = star.dim_date(spark, "2027-01-01", "2027-01-02").first()
    assert row.date_year is None and row.date_week == 53 and row.day_of_week == 5
    assert row.name_date_month == "January" and row.name_day_of_week == "Friday"
    assert row.is_weekend_ind is False and row.total_days_in_month == 31
    assert star.dim_date(spark, "2027-01-01", "2027-01-02", corrected=True).first().date_year == 2027
