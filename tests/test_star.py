"""Deduplication, merchants, categories and pay."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passbook.functions.text import java_pattern, java_pattern_column
from passbook.operators.categorize import categorize, literal_grams, matches
from passbook.operators.latest import collapse_near_duplicates
from passbook.plans import star
from tests.plan import plan_of
from tests.rows import catalog, fact, flat, flat_row, rates

RULES = [
    ("food", "grocery", "^.*(shop|market).*$", 10),
    ("food", "bakery", "^.*(corner).*$", 10),
    ("debt", "card", "^.*(transfer to credit card).*$", 5),
    ("transfers", "other account", "^.*(transfer to|transfer from).*$", 10),
    ("fees", "ends", "^fee$", 10),
    ("none", "null pattern", None, 1),
    ("last", "no priority", "^.*(corner market).*$", None),
    ("it's", "a \\ b\"c", "(o'neil's|[$]{2}|\\$a)", 10),
    (None, "first of all", "^.*(zero).*$", 0),
    ("late", "also zero", "^.*(zero).*$", 1),
]


def test_latest_posting_wins_and_dedup_is_idempotent(spark):
    rows = [
        flat_row("t", "2026-01-01T00:00:00", "1.00", filename="f9"),
        flat_row("t", "2026-01-02T00:00:00", "2.00", filename="f1"),
        flat_row("t", "2026-01-02T00:00:00", "2.00", filename="f2"),
        flat_row(None, "2026-01-02T00:00:00", "5.00"),
        flat_row(None, "2026-01-03T00:00:00", "6.00"),
    ]
    once = star.latest_transactions(flat(spark, rows))
    kept = {(r.txn_id, r.amount, r.filename) for r in once.collect()}
    assert kept == {("t", Decimal("2.00"), "f2"), (None, Decimal("6.00"), "f1")}
    twice = star.latest_transactions(once.unionByName(once))
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_near_duplicates_collapse_over_null_columns(spark):
    rows = [
        flat_row("a", "2026-01-01T00:00:00", "-5.00", payee=None),
        flat_row("b", "2026-01-01T00:00:00", "-5.00", payee=None),
        flat_row("c", "2026-01-01T00:00:00", "-5.01", payee=None),
        flat_row("d", "2026-01-01T00:00:01", "-5.00", payee=None),
    ]
    kept = {r.txn_id for r in collapse_near_duplicates(fact(spark, rows)).collect()}
    assert kept == {"a", "c", "d"}


def test_merchant_totals_periods_and_categories(spark):
    rows = [
        flat_row("1", "2026-06-30T00:00:00", "-1.00"),
        flat_row("2", "2026-06-29T00:00:00", "-2.00"),  # one day back, inclusive
        flat_row("3", "2026-06-28T23:59:59", "-4.00"),
        flat_row("4", "2026-05-30T00:00:00", "-8.00"),  # one month back
        flat_row("5", "2026-03-30T00:00:00", "-16.00"),  # three months back
        flat_row("6", "2025-06-30T00:00:00", "-32.00"),  # one year back
        flat_row("7", "2025-06-29T23:59:59", "-64.00"),
        flat_row("8", "2026-06-01T00:00:00", "9.00", "Transfer To Credit Card 1", "Bank"),
        flat_row("9", "2026-06-01T00:00:00", "-3.00", "mystery", None),
        flat_row("10", "2026-06-01T00:00:00", "-3.00", None, None),
    ]
    dim = star.dim_merchant(fact(spark, rows), catalog(spark, RULES))
    got = {r.merchant_name or "-" if r.merchant_category != "**UNKNOWN**" else "?": r for r in dim.collect()}
    shop = got["shop"]
    # "corner shop" matches two patterns of priority 10: category, then subcategory.
    assert (shop.merchant_category, shop.merchant_subcategory) == ("food", "bakery")
    assert shop.total_transactions == 7 and shop.total_amount == Decimal("-127.00")
    assert [
        shop.amount_past_day,
        shop.amount_past_week,
        shop.amount_past_month,
        shop.amount_past_quarter,
        shop.amount_past_year,
    ] == [Decimal(f"-{n}.00") for n in (3, 7, 15, 31, 63)]
    assert got["bank"].merchant_category == "debt"
    assert got["bank"].amount_past_day == 0
    assert dim.where("merchant_category = '**UNKNOWN**'").count() == 2


def test_one_row_per_key_when_payee_holds_the_separator(spark):
    rows = [
        flat_row("1", "2026-06-01T00:00:00", "-1.00", "b||shop", "a"),
        flat_row("2", "2026-06-01T00:00:00", "-2.00", "shop", "a||b"),
        flat_row("3", "2026-06-01T00:00:00", "-4.00", "fee", "a||b"),
    ]
    dim = star.dim_merchant(fact(spark, rows), catalog(spark, RULES))
    assert dim.count() == 2
    shop = dim.where("merchant_category = 'food'").first()
    # Periods are per key, totals per payee and description.
    assert shop.amount_past_day == Decimal("-3.00")
    assert shop.total_amount == Decimal("-1.00")


def test_period_sums_grow_by_inclusion(spark):
    rows = [
        flat_row(str(i), f"2026-{1 + i % 6:02d}-{1 + i % 28:02d}T00:00:00", f"-{i}.25", f"shop {i % 5}")
        for i in range(1, 120)
    ]
    dim = star.dim_merchant(fact(spark, rows), catalog(spark, RULES))
    names = ["day", "week", "month", "quarter", "year"]
    for row in dim.collect():
        sums = [-row[f"amount_past_{name}"] for name in names]
        assert sums == sorted(sums) and sums[-1] <= -row.total_amount


TEXTS = [
    "corner shop",
    "corner market",
    "transfer to credit card",
    "fee",
    "fee\n",
    "a\nshop",
    "shop\nb",
    "x\rshop",
    "shop\u2028b",
    "",
    None,
    "transfer from shop",
    "o'neil's",
    "$$",
    "x$a",
    "zero shop",
]


PATTERNS = [
    r"^.*(bolt|gear).*$", r"a\$|[$]b$", r"(x$|y)", r"\\$", r"^[]$]+$", "shop$", "", "(fee|)", "(?i)FEE", r"f\x65e",
    "co?rner", "cor+ner", "(cor|mar)+ket", "(corner )?shop", "(corner|zero) (shop|market)", "o.neil", "wal.?mart",
    r"bad ?daddy", r"transfer (to|from)", "corner shop|fee", "a|b", "shop{1}", "[a-z]*hop", "x(?:$|a)", "((shop))",
    "credit card$", "no such text", r"shop\b", r"(?!fee)f", "e+", "fe+?$", "ma*rket", "s.*?p", r"\Qfee\E", "$$", "'",
]


def test_categories_equal_a_search_of_all_pairs(spark):
    texts = [*TEXTS, "corket", "marcorket", "corrrner", "wal-mart", "walmart", "baddaddy", "bad daddy", "FEE", "x", "y", "\x01"]
    con = duckdb.connect()
    rules = [(f"c{i % 5}", f"s{i}", pattern, i % 3) for i, pattern in enumerate(PATTERNS) if "(?!" not in pattern]
    rules += [("c0", "again", "shop$", 0), ("c0", None, None, 0), (None, "s", "shop", None)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: r for r in categorize(df, catalog(spark, rules), "text").collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        fits = [
            ((rule[3] is None, rule[3] or 0, rule[0] is None, rule[0] or "", rule[1] or "", rule[2]), rule)
            for rule in rules
            if text is not None and rule[2] is not None
            and con.execute("SELECT regexp_matches(?, ?)", [text, rule[2]]).fetchone()[0]
        ]
        best = min(fits)[1] if fits else (None, None, None, None)
        want = (best[0] or "**UNKNOWN**", best[1] or "**UNKNOWN**", best[3])
        row = got[i]
        assert (row.merchant_category, row.merchant_subcategory, row.match_priority) == want, text


def test_all_matching_pairs_are_found(spark):
    pieces = ["ab", "abc", "b+", "c?", "(ab|bc)", "(a|cab)+", "[abc]", ".", "a*", r"\w", "cab", "(?:bca|ca)", "|", "^", "(abc)?"]
    pick = random.Random(3)
    patterns = {"".join(pick.choices(pieces, k=pick.randint(1, 4))) for _ in range(150)}
    texts = ["".join(pick.choices("abc", k=pick.randint(0, 9))) for _ in range(60)]
    as_column = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    got = {tuple(r) for r in matches(as_column(texts, "text"), as_column(patterns, "pattern")).collect()}
    assert got == {(t, p) for t in texts for p in patterns if re.search(p, t)}


def test_the_index_reads_alternatives(spark):
    grams = spark.createDataFrame([(p,) for p in PATTERNS], "p string").select("p", literal_grams(F.col("p")).alias("g"))
    read = {r.p: [sorted(part) for part in r.g] for r in grams.collect()}
    assert read["^.*(bolt|gear).*$"] == [["bol", "olt"], ["ear", "gea"]]
    assert read["co?rner"] == [["ner", "rne"]] and read["cor+ner"] == [["cor", "ner"]]
    assert read["wal.?mart"] == [["art", "mar", "wal"]]
    for pattern in ("", "(fee|)", "(?i)FEE", r"f\x65e", "a|b", "(corner )?shop", "((shop))", r"\Qfee\E", "shop{1}"):
        assert read[pattern] == [], pattern


def test_categories_meet_by_equality(spark):
    df = spark.createDataFrame([(1, "corner shop")], "id int, text string")
    plan = plan_of(categorize(df, catalog(spark, RULES), "text"))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_patterns_match_like_the_oracle_engine(spark):
    patterns = [r[2] for r in RULES if r[2]] + [r"a\$|[$]b$", r"(x$|y)", r"\\$", r"^[]$]+$", "shop$"]
    texts = [t for t in TEXTS if t is not None] + ["a$", "$b", "x", "y\n", "x\n", "\\", "]$"]
    con = duckdb.connect()
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for pattern in patterns:
        want = [con.execute("SELECT regexp_matches(?, ?)", [t, pattern]).fetchone()[0] for t in texts]
        literal = df.select(F.col("text").rlike(java_pattern(pattern)).alias("m")).collect()
        column = df.select(
            F.rlike(F.col("text"), java_pattern_column(F.lit(pattern))).alias("m")
        ).collect()
        assert [r.m for r in literal] == want, pattern
        assert [r.m for r in column] == want, pattern


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="$\\[]a^.", max_size=8))
def test_end_anchor_rewrite_keeps_other_characters(text):
    rewritten = java_pattern(text).removeprefix("(?d)")
    assert rewritten.replace(r"\z", "$") == text or r"\z" in text


def test_daily_pay_gap_overlap_and_open_end(spark):
    days = star.dim_date(spark, "2026-01-01", "2026-03-01")
    pay = star.fact_daily_pay(
        days,
        rates(
            spark,
            [
                ("Acme", "1000.00", "2026-01-02", "2026-01-31"),
                ("Beta", "700.00", "2026-01-31", "9999-12-31"),
                ("Backwards", "1.00", "2026-01-20", "2026-01-10"),
            ],
        ),
        as_of="2026-02-10",
    )
    rows = pay.collect()
    by_day: dict[dt.date, list] = {}
    for row in rows:
        by_day.setdefault(row.calendar_date, []).append(row)
    assert max(by_day) == dt.date(2026, 2, 10) and len(by_day) == 41
    assert by_day[dt.date(2026, 1, 1)][0].daily_income is None
    assert by_day[dt.date(2026, 1, 2)][0].daily_income == Decimal("64.52")
    assert {r.from_employer for r in by_day[dt.date(2026, 1, 31)]} == {"Acme", "Beta"}
    assert by_day[dt.date(2026, 2, 1)][0].daily_income == Decimal("50.00")
