"""Mart rules on small inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from passbook.plans import marts, reports, star
from tests.rows import catalog, fact, flat_row, rates

RULES = [
    ("food", "grocery", "^.*(shop).*$", 10),
    ("payments", "paycheck", "^.*(payroll).*$", 10),
    ("debt", "card", "^.*(transfer to credit card).*$", 5),
    ("transfers", "other account", "^.*(transfer to|transfer from).*$", 10),
]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        flat_row("1", "2026-01-05T10:00:00", "-100.00"),
        flat_row("2", "2026-01-06T10:00:00", "30.00"),  # refund, net stays negative
        flat_row("3", "2026-01-06T10:00:00", "30.00"),  # near duplicate of 2
        flat_row("4", "2026-01-07T10:00:00", "-10.00", "transfer to credit card", "Bank"),
        flat_row("5", "2026-01-07T10:00:00", "-20.00", "transfer to savings", "Bank"),
        flat_row("6", "2026-01-08T10:00:00", "500.00", "payroll", "Acme"),
        flat_row("7", "2026-01-08T11:00:00", "-5.00", "payroll", "Acme"),  # net positive
        flat_row("8", "2026-02-09T10:00:00", "-50.00"),
        flat_row("9", "2026-02-10T10:00:00", "40.00", "payroll", "Acme"),
        flat_row("10", "2026-03-10T10:00:00", "-7.00", "mystery", None),
        flat_row("11", "2026-04-20T10:00:00", "-9.00"),
    ]
    f = fact(spark, rows)
    m = star.dim_merchant(f, catalog(spark, RULES)).persist()
    return f, m, marts.rpt_expenses_detail(f, m).persist(), marts.rpt_income_detail(f, m).persist()


def test_expenses_follow_the_net_sign(tables):
    spent = sorted((r.txn_description, r.amount_spent) for r in tables[2].collect())
    assert spent == [
        ("corner shop", Decimal("-30.00")),
        ("corner shop", Decimal("9.00")),
        ("corner shop", Decimal("50.00")),
        ("corner shop", Decimal("100.00")),
        ("mystery", Decimal("7.00")),
        ("transfer to credit card", Decimal("10.00")),
    ]


def test_income_excludes_transfer_categories(tables):
    earned = sorted((r.txn_description, r.amount_earned) for r in tables[3].collect())
    assert earned == [
        ("corner shop", Decimal("30.00")),
        ("payroll", Decimal("40.00")),
        ("payroll", Decimal("500.00")),
    ]


def test_unknown_transactions(tables):
    rows = marts.rpt_unknown_transactions(tables[0], tables[1]).collect()
    assert [r.txn_description for r in rows] == ["mystery"]


def test_monthly_savings_and_its_corrected_form(tables):
    rows = {r.year_month: r for r in marts.rpt_monthly_savings(tables[2], tables[3]).collect()}
    assert set(rows) == {dt.date(2026, 1, 1), dt.date(2026, 2, 1)}
    jan, feb = rows[dt.date(2026, 1, 1)], rows[dt.date(2026, 2, 1)]
    assert (jan.total_spend, jan.total_earned) == (Decimal("80.00"), Decimal("530.00"))
    assert jan.dollars_saved == Decimal("450.00") and jan.dollars_lost == 0
    assert feb.dollars_lost == Decimal("-10.00") and feb.dollars_saved == 0
    assert feb.pcnt_saved == feb.pcnt_lost == Decimal("-0.2500")
    fixed = {r.year_month: r for r in marts.rpt_monthly_savings(tables[2], tables[3], corrected=True).collect()}
    assert fixed[dt.date(2026, 2, 1)].pcnt_saved == 0
    assert fixed[dt.date(2026, 1, 1)].pcnt_lost == 0


def overunder(spark, tables, pay):
    days = star.dim_date(spark, "2026-01-01", "2026-05-01")
    daily = star.fact_daily_pay(days, rates(spark, pay), "2026-04-30")
    return marts.rpt_daily_overunder(tables[2], daily)


def test_daily_colors(spark, tables):
    pay = [
        ("Equal", "1550.00", "2026-01-05", "2026-01-05"),  # 100.00 a day
        ("Close", "500.00", "2026-01-07", "2026-01-07"),  # 32.26 against 10.00
        ("Short", "140.00", "2026-02-09", "2026-02-09"),  # 10.00 against 50.00
        ("Rich", "1550.00", "2026-03-10", "2026-03-10"),
    ]
    rows = {r.calendar_date: r for r in overunder(spark, tables, pay).collect()}

    def day(month, number):
        return rows[dt.date(2026, month, number)]

    assert day(1, 5).day_color == "Black"
    assert day(1, 7).day_color == "Grey" and day(1, 7).dollars_over == Decimal("22.26")
    assert day(2, 9).day_color == "Red" and day(2, 9).dollars_under == Decimal("-40.00")
    assert day(3, 10).day_color == "Green"
    # No income and no spend: Green.  Spend without income: no colour, no deficit.
    assert day(1, 1).day_color == "Green" and day(1, 1).dollars_over == 0
    assert day(4, 20).day_color is None and day(4, 20).dollars_under == 0
    assert day(4, 20).daily_income == 0 and day(4, 20).daily_spend == Decimal("9.00")


def test_month_over_month_uses_the_previous_month_present(spark, tables):
    daily = overunder(spark, tables, [("Acme", "700.00", "2026-01-01", "2026-12-31")])
    rows = marts.rpt_mom_performance(tables[0], daily, "2026-04-15").collect()
    by_month = {r.month: r for r in rows}
    # April has a row on day 20 only, past the cut on day 15.
    assert set(by_month) == {1, 2, 3}
    assert by_month[1].year is None and by_month[1].this_time_last_month_balance is None
    # Near duplicates and the card transfer: both refunds count, no transfers do.
    assert by_month[1].current_monthly_balance == Decimal("455.00")
    assert by_month[2].dollars_mom_balance_delta == Decimal("-465.00")
    assert by_month[2].pcnt_mom_balance_delta == Decimal("-1.0200")
    assert by_month[3].last_month_total_red_days == 0
    assert by_month[3].pcnt_mom_total_red_days is None
    fixed = marts.rpt_mom_performance(tables[0], daily, "2026-04-15", corrected=True)
    assert {r.year for r in fixed.collect()} == {2026}


def test_top_expenses_average_is_inverted_unless_corrected(tables):
    plain = {r.category: r for r in marts.rpt_top_expenses(tables[1]).collect()}
    fixed = {r.category: r for r in marts.rpt_top_expenses(tables[1], corrected=True).collect()}
    assert set(plain) == {"food", "debt", "**UNKNOWN**"}
    assert plain["food"].total_spend == Decimal("99.00")
    assert plain["food"].avg_spend_per_txn == Decimal("0.05")
    assert fixed["food"].avg_spend_per_txn == Decimal("19.80")


def test_trailing_reports_cover_the_current_month_and_six_before(tables):
    rows = reports.rows_income(tables[3], as_of="2026-07-31").collect()
    assert [r.posted_date for r in rows] == [
        dt.date(2026, 2, 10),
        dt.date(2026, 1, 8),
        dt.date(2026, 1, 6),
    ]
    assert rows[0].income_type == "payments | paycheck"
    assert reports.rows_income(tables[3], as_of="2026-08-01").count() == 1


def test_inputs_that_do_not_parse_are_ignored(tables):
    all_rows = reports.flt_rows_all_expenses(tables[2], lower="soon", upper="")
    assert all_rows.count() == tables[2].count()
    some = reports.flt_rows_all_expenses(tables[2], lower="2026-02-01", categories=["food"])
    assert some.count() == 2
    capped = reports.flt_chart_col_expenses(tables[2], dollar_cap="1,000.5", categories=["food"])
    assert capped.first().total_spend == Decimal("129.00")


def test_total_row_is_last_word_of_a_listing(tables):
    from passbook.operators.listing import with_total_row

    listing = with_total_row(reports.rows_all_expenses(tables[2]), ["amount_spent"])
    total = listing.where("is_total").first()
    assert total.amount_spent == Decimal("146.00") and total.account is None
    assert listing.count() == 7
