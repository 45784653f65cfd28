"""What is shuffled, stored and gathered: columns and joins that large tables would not bear."""

from __future__ import annotations

from pyspark.sql import functions as F

import pyarrow.parquet as pq
import pytest

from passbook.operators.categorize import _held, categorize, pattern_index
from passbook.operators.latest import (
    NEAR_DUPLICATE_KEYS,
    collapse_near_duplicates,
    matches_apart,
    may_match,
    repeats_apart,
)
from passbook.operators.lookup import small
from passbook.plans import history, marts, refresh, star
from passbook.plans.build import build_all
from passbook.plans.refresh import corrected_transactions, judged_arrivals
from passbook.schemas import FLAT_ACCOUNT, FLAT_TRANSACTION
from passbook.sources.tables import Release
from tests.plan import plan_of
from testbed.ledger import Warehouse, ledger
from tests.rows import catalog, fact, flat, flat_row

ROWS = [
    flat_row("t1", "2026-03-01T10:00:00", "-5.00"),
    flat_row("t2", "2026-03-01T10:00:00", "-5.00"),
    flat_row("t3", "2026-03-02T10:00:00", "-7.00", payee=None),
    flat_row("t4", "2026-03-03T10:00:00", "9.00", description=None),
]


def test_snapshots_place_only_the_columns_they_list(spark, monkeypatch):
    stored = []
    placed = history.placed

    def seen(rows, *rest):
        stored.append(set(rows.columns))
        return placed(rows, *rest)

    monkeypatch.setattr(history, "placed", seen)
    dates = ("2026-03-31", "2026-03-01", 30)
    history.trailing_snapshots(fact(spark, ROWS), *dates)
    assert not stored[0] & {"filename", "merchant_category_key", "record_loaded_at_timestamp"}
    few = history.trailing_rows(fact(spark, ROWS), *dates, columns=())
    assert stored[1] == {"as_of_date", "bank_account_name", "posted_at_timestamp", "txn_id"}
    whole = history.trailing_rows(fact(spark, ROWS), *dates).select(*few.columns)
    assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_rows_of_quiet_accounts_are_shuffled_once_for_their_snapshots(spark, tmp_path, monkeypatch):
    rows = [flat_row(f"t{k}", f"2026-0{k % 5 + 1}-{k % 28 + 1:02d}T10:00:00", "-5.00", account=f"A{k % 7}") for k in range(300)]
    rows += [flat_row(f"n{k}", "2026-03-03T10:00:00", "1.00", account=None) for k in range(40)]
    fact(spark, rows).write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    dates = ("2026-05-31", "2026-01-15", 30)
    n_placed, place = [], history.placed

    def seen(rows, *rest):
        n_placed.append(rows.count())
        return place(rows, *rest)

    monkeypatch.setattr(history, "placed", seen)
    quiet = history.trailing_snapshots(stored, *dates)
    # No row is stored to be placed; they meet by the account alone, before they unfold.
    assert n_placed == [0]
    dealt = [line for line in plan_of(quiet).splitlines() if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 1 and "bank_account_name" in dealt[0] and "as_of_date" not in dealt[0]
    told = lambda df: sorted(map(str, df.collect()))
    # Some accounts, the one without a name among them, or all of them over many tasks.
    assert sorted(map(str, history.busy_accounts(stored, 39))) == [*(f"A{k}" for k in range(7)), "None"]
    assert set(history.busy_accounts(stored, 42)) == {f"A{k}" for k in range(6)}
    for busy_rows in (39, 42):
        assert told(history.trailing_snapshots(stored, *dates, busy_rows=busy_rows)) == told(quiet)


def test_categories_are_not_gathered_for_a_broadcast(spark, tmp_path):
    texts = spark.range(50).select(F.concat(F.lit("shop number "), "id").alias("text"))
    texts.write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    rules = texts.select(
        F.lit("c").alias("merchant_category"),
        F.lit("s").alias("merchant_subcategory"),
        F.concat(F.lit("^"), "text", F.lit("$")).alias("regex_match_pat"),
        F.lit(1).alias("match_priority"),
    )
    found = categorize(texts, rules, "text")
    assert plan_of(found).count("SortMergeJoin") >= 3
    assert found.where("merchant_category = 'c'").count() == 50


def test_a_pattern_meets_few_texts_however_many_there_are(spark):
    texts = spark.range(4000).select(F.concat(F.lit("shop#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("text"))
    patterns = texts.select(F.concat(F.lit("^.*("), "text", F.lit(").*$")).alias("pattern"))
    met = pattern_index(patterns, texts).join(_held(texts), "gram")
    assert met.count() == 4000


def test_few_bytes_of_texts_unfold_in_many_tasks(spark, tmp_path):
    names = spark.range(300).select(F.concat(F.lit("shop number "), "id").alias("text"))
    names.coalesce(1).write.parquet(str(tmp_path / "names"))
    stored = spark.read.parquet(str(tmp_path / "names"))
    rules = stored.select(
        F.lit("c").alias("merchant_category"),
        F.lit("s").alias("merchant_subcategory"),
        F.concat(F.lit("^"), "text", F.lit("$")).alias("regex_match_pat"),
        F.lit(1).alias("match_priority"),
    )
    found = categorize(stored, rules, "text")
    assert found.where("merchant_category = 'c'").count() == 300
    dealt = [line for line in plan_of(found).splitlines() if "REPARTITION_BY_NUM" in line and "xxhash64" in line]
    assert dealt


def test_the_collapse_shuffles_no_merchant_key(spark, tmp_path):
    fact(spark, ROWS).write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    merchants = star.dim_merchant(stored, catalog(spark, [("food", "shop", "shop", 1)]))
    merchants.write.parquet(str(tmp_path / "merchants"))
    labelled = marts.labelled_transactions(stored, spark.read.parquet(str(tmp_path / "merchants")))
    scan = next(s for s in plan_of(labelled).split("\n\n") if "Scan parquet" in s and "filename" in s)
    assert "merchant_category_key" not in scan
    keys = {r.txn_id: r.merchant_category_key for r in stored.collect()}
    got = {r.txn_id: r.merchant_category_key for r in labelled.collect()}
    assert got == {name: keys[name] for name in ("t1", "t3", "t4")}


def test_derived_columns_are_taken_anew_after_the_sort(spark, tmp_path):
    rows = fact(spark, ROWS)
    with Release(spark, str(tmp_path)) as release:
        back = release.write(
            rows, "fact_transactions", ["posted_at_timestamp", "txn_id"], ["txn_id"], star.derived_columns("fact_transactions")
        )
        release.publish()
    assert back.columns == rows.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_files_are_sorted_runs_without_an_exchange(spark, tmp_path):
    rows = [flat_row(f"t{k}", f"2026-03-{k % 28 + 1:02d}T10:00:00", "-5.00") for k in range(60)]
    dealt = fact(spark, rows).repartition(4)
    with Release(spark, str(tmp_path)) as release:
        back = release.write(dealt, "fact_transactions", ["posted_at_timestamp", "txn_id"])
        release.publish()
    files: dict = {}
    for row in back.select("_metadata.file_path", "_metadata.row_index", "posted_at_timestamp", "txn_id").collect():
        files.setdefault(row.file_path, []).append((row.row_index, row.posted_at_timestamp, row.txn_id))
    assert len(files) == 4 and back.count() == 60
    for members in files.values():
        in_file = [m[1:] for m in sorted(members)]
        assert in_file == sorted(in_file)


def test_arrivals_are_judged_by_ids_and_digests(spark, tmp_path):
    fact(spark, [*ROWS, flat_row(None, "2026-03-01T10:00:00", "-1.00")]).write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    arrived = [
        ROWS[0],
        ROWS[2],
        ROWS[2],
        flat_row("t2", "2026-02-01T10:00:00", "-6.00"),
        flat_row("t4", "2026-03-03T10:00:00", "9.00", description="now told"),
        flat_row("t5", "2026-03-04T10:00:00", "1.00", payee=None),
        flat_row(None, "2026-03-02T10:00:00", "-2.00"),
    ]
    flat(spark, arrived).write.parquet(str(tmp_path / "arrived"))
    judged = judged_arrivals(stored, spark.read.parquet(str(tmp_path / "arrived")))
    got = {r.txn_id: r.is_new for r in judged.collect()}
    assert got == {"t2": False, "t4": False, "t5": True, None: False}
    # An older posting and an unchanged row replace nothing.
    corrected = corrected_transactions(stored, judged)
    assert {(r.txn_id, str(r.amount)) for r in corrected.collect()} == {("t4", "9.00"), (None, "-2.00")}
    # The fact's part of the shuffle is two columns.
    exchanges = [part for part in plan_of(judged).split("\n\n") if "Exchange" in part and "_stored" in part]
    assert exchanges and not any("txn_description" in part.split("Input", 1)[1].split("\n")[0] for part in exchanges)


def test_tasks_read_bounded_pieces(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"


def _repeating(spark):
    """Rows of a fact in which some ids and some near duplicates repeat."""

    def row(k: int, name: str | None, filename: str = "f1") -> tuple:
        return flat_row(name, f"2026-03-{k % 28 + 1:02d}T10:00:00", f"-{k}.00", filename=filename)

    rows = [row(k, f"t{k}") for k in range(300)] + [row(k, f"t{k}b") for k in range(20)]
    rows += [row(k, f"t{k}", "z") for k in range(5, 15)] + [row(k, None) for k in (1, 2, 2)]
    return star.as_fact(flat(spark, rows), "2026-08-01 00:00:00")


def _staging(spark, tmp_path):
    def staged(df, name):
        path = f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return staged


@pytest.mark.parametrize("bits", [None, 64, 4096])
def test_rows_that_repeat_are_told_apart_whole(spark, tmp_path, bits):
    staged = _staging(spark, tmp_path)
    rows = staged(_repeating(spark), "fact")
    for keys in (["txn_id"], list(NEAR_DUPLICATE_KEYS)):
        once, several = repeats_apart(rows, keys, staged, bits)
        assert once.columns == several.columns == rows.columns
        both = [*map(tuple, once.collect()), *map(tuple, several.collect())]
        assert sorted(both, key=str) == sorted(map(tuple, rows.collect()), key=str)
        assert once.groupBy(*keys).count().where("count > 1").count() == 0
        assert once.select(*keys).intersect(several.select(*keys)).count() == 0
        assert bits == 64 or several.count() < 100
    once, several = repeats_apart(rows.where("txn_id = 't7' AND filename <> 'z'"), ["txn_id"], staged)
    assert several is None and once.count() == 1


def test_corrections_meet_few_rows_of_the_fact(spark, tmp_path):
    staged = _staging(spark, tmp_path)
    stored = staged(_repeating(spark).where("filename = 'f1' AND NOT (txn_id IS NULL AND amount < -1)"), "fact")
    late = [
        flat_row("t7", "2026-03-20T10:00:00", "-1.00"),
        flat_row("t8", "2025-03-20T10:00:00", "-1.00"),
        flat_row("new", "2026-03-20T10:00:00", "-1.00"),
        flat_row(None, "2026-03-20T10:00:00", "-4.00"),
    ]
    judged = staged(judged_arrivals(stored, flat(spark, late)), "judged")
    near = may_match(stored, "txn_id", judged.where("NOT is_new"), staged)
    assert near.columns == stored.columns and near.count() < 30
    assert {"t7", "t8", None} <= {r.txn_id for r in near.collect()}
    assert "Exchange hashpartitioning" not in plan_of(near)
    got = sorted(map(tuple, corrected_transactions(stored, judged, staged).collect()), key=str)
    assert got == sorted(map(tuple, corrected_transactions(stored, judged).collect()), key=str)
    assert {row[2] for row in got} == {"t7", None}


def test_arrivals_and_rows_of_the_fact_meet_only_where_ids_may_be_shared(spark, tmp_path):
    staged = _staging(spark, tmp_path)
    stored = staged(_repeating(spark).where("filename = 'f1' AND NOT (txn_id IS NULL AND amount < -1)"), "fact")
    late = [
        flat_row("t7", "2026-03-20T10:00:00", "-1.00"),
        flat_row("t8", "2025-03-20T10:00:00", "-1.00"),
        flat_row("t8", "2025-03-21T10:00:00", "-1.00"),
        flat_row(None, "2026-03-20T10:00:00", "-4.00"),
        *[flat_row(f"new{k}", "2026-03-20T10:00:00", "-1.00") for k in range(100)],
        flat_row("new5", "2026-03-21T10:00:00", "-1.00"),
    ]
    arrived = staged(flat(spark, late).unionByName(stored.where("txn_id < 't2'").select(*FLAT_TRANSACTION.names)), "arrived")
    judged, plain = judged_arrivals(stored, arrived, staged), judged_arrivals(stored, arrived)
    got = sorted(map(tuple, judged.collect()), key=str)
    assert got == sorted(map(tuple, plain.collect()), key=str) and len(got) == 103
    # Rows whose id no other row shares come without an exchange.
    assert plan_of(judged).split("Exchange")[0].count("Union") == 1


def test_rows_taken_apart_by_a_key_are_all_rows(spark, tmp_path):
    staged = _staging(spark, tmp_path)
    stored = staged(_repeating(spark), "fact")
    wanted = stored.where("txn_id IS NULL OR txn_id IN ('t7', 't8')").select("txn_id")
    others, near = matches_apart(stored, "txn_id", wanted, staged)
    both = [*map(tuple, others.collect()), *map(tuple, near.collect())]
    assert sorted(both, key=str) == sorted(map(tuple, stored.collect()), key=str)
    assert others.where("txn_id IS NULL OR txn_id IN ('t7', 't8')").count() == 0
    assert near.count() < 30 and "Exchange hashpartitioning" not in plan_of(others)
    nothing = matches_apart(stored, "txn_id", wanted.limit(0), staged)
    assert [rows.count() for rows in nothing] == [stored.count(), 0]


def test_few_rows_are_marked_by_chance(spark, tmp_path):
    staged = _staging(spark, tmp_path)
    rows = staged(spark.range(20_000).selectExpr("cast(if(id < 4000, id div 2, id) AS string) AS k"), "rows")
    several = repeats_apart(rows, ["k"], staged, 1 << 14)[1]
    assert 4000 <= several.count() < 4900


def test_merchant_keys_are_stored_as_numbers_of_a_dictionary(spark, tmp_path):
    names = spark.range(80_000).selectExpr("cast(id div 2 AS string) AS payee")
    rows = fact(spark, [flat_row("t", "2026-03-01T10:00:00", "-5.00")]).drop("payee", "merchant_category_key")
    dealt = rows.crossJoin(names).withColumn("merchant_category_key", F.md5("payee")).coalesce(1)
    with Release(spark, str(tmp_path)) as release:
        back = release.write(dealt, "fact_transactions", ["posted_at_timestamp"])
        release.publish()
    (path,) = {r[0].removeprefix("file://") for r in back.select("_metadata.file_path").distinct().collect()}
    group = pq.ParquetFile(path).metadata.row_group(0)
    column = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == "merchant_category_key")
    assert back.count() == 80_000 and "PLAIN" not in column.encodings


def test_only_rows_that_may_repeat_are_shuffled(spark, tmp_path):
    staged = _staging(spark, tmp_path)
    rows = staged(_repeating(spark), "fact")
    for found, want in (
        (star.latest_of_stored(rows, staged), star.latest_transactions(rows)),
        (collapse_near_duplicates(rows, staged), collapse_near_duplicates(rows)),
    ):
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        plan = plan_of(found)
        assert plan.split("Exchange")[0].count("Union") == 1 and "BroadcastHashJoin" in plan


def test_details_broadcast_few_merchants_whatever_the_session_does(spark, tmp_path):
    staged = _staging(spark, tmp_path)
    rows = staged(fact(spark, ROWS), "fact")
    merchants = staged(star.dim_merchant(rows, catalog(spark, [("food", "shop", "shop", 1)])), "merchants")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_of(marts.labelled_transactions(rows, merchants))
        labelled = marts.labelled_transactions(rows, small(merchants), staged)
        assert "SortMergeJoin" not in plan_of(labelled)
        assert {r.txn_id for r in labelled.collect()} == {"t1", "t3", "t4"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_details_meet_the_changed_merchants_once(spark, tmp_path, monkeypatch):
    root, accounts = str(tmp_path / "root"), spark.createDataFrame([], FLAT_ACCOUNT)
    first = [*ROWS, flat_row("t6", "2026-03-05T10:00:00", "-2.00", "corner shop", "Other")]
    calendar = ("2026-01-01", "2026-04-01")
    build_all(spark, root, as_of="2026-03-31", calendar=calendar, stores=(flat(spark, first), accounts))
    met, matched = [], refresh._matched

    def seen(rows, keys, on, name, how):
        if name == refresh.KEY and {"amount_spent", "amount_earned"} & set(rows.columns):
            met.append(how)
        return matched(rows, keys, on, name, how)

    monkeypatch.setattr(refresh, "_matched", seen)
    late = [flat_row("t7", "2026-03-09T10:00:00", "-4.00", "corner shop", "Other")]
    redone = refresh.refresh_all(spark, root, flat(spark, late), "2026-03-31")
    assert met == ["left_anti", "left_anti"]
    assert redone["days"] == 1 and redone["transactions"] == 1


def test_the_stored_fact_shuffles_only_rows_whose_id_may_repeat(spark, tmp_path, monkeypatch):
    lines = [(order, line, 1, 1, 10.5, "R" if order % 2 else "N", "F") for order in range(40) for line in (1, 2)]
    lines += lines[:6]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string"
    line = spark.createDataFrame(lines, columns).withColumn("l_shipdate", F.lit("2026-03-01").cast("date"))
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = "id o_orderkey, 1L o_custkey, '2-HIGH' o_orderpriority, 'O' o_orderstatus".split(", ")
    spark.range(40).selectExpr(*orders).write.parquet(f"{tmp_path}/orders.parquet")
    one = spark.range(1)
    one.selectExpr("1L c_custkey", "'Customer#1' c_name", "'FURNITURE' c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    part = ("1L p_partkey", "'SMALL TIN' p_type", "'red plate' p_name", "'Brand#1' p_brand")
    one.selectExpr(*part).write.parquet(f"{tmp_path}/part.parquet")
    shuffled, latest = [], star.latest_transactions

    def seen(flat_rows, *ties):
        shuffled.append(flat_rows.count())
        return latest(flat_rows, *ties)

    warehouse = Warehouse(spark, str(tmp_path))
    want = warehouse.plan("fact_transactions").drop("record_loaded_at_timestamp").collect()
    monkeypatch.setattr(star, "latest_transactions", seen)
    got = warehouse.table("fact_transactions").drop("record_loaded_at_timestamp").collect()
    assert sorted(got) == sorted(want) and len(got) == 120
    assert len(shuffled) == 1 and shuffled[0] < 40


def test_ledger_lines_are_narrow_when_they_meet_their_orders(spark, tmp_path):
    one = spark.range(1)
    tables = {
        "lineitem": "1L l_orderkey, 1 l_linenumber, 1L l_partkey, 1L l_suppkey, 10.5D l_extendedprice,"
        " 'R' l_returnflag, 'F' l_linestatus, date'2026-03-01' l_shipdate",
        "orders": "1L o_orderkey, 1L o_custkey, '1-URGENT' o_orderpriority, 'O' o_orderstatus",
        "customer": "1L c_custkey, 'Customer#1' c_name, 'FURNITURE' c_mktsegment",
        "part": "1L p_partkey, 'SMALL TIN' p_type, 'red plate' p_name, 'Brand#1' p_brand",
    }
    for name, columns in tables.items():
        one.selectExpr(*columns.replace(", ", ",").split(",")).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = ledger(spark, str(tmp_path))
        plan = plan_of(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [p.split("Input", 1)[1].split("\n")[0] for p in plan.split("\n\n") if ") Exchange" in p and "Input" in p]
    assert len(exchanges) == 6
    for wide in ("l_extendedprice", "l_returnflag", "l_linestatus", "o_orderpriority", "c_mktsegment", "p_type"):
        assert not any(wide in columns for columns in exchanges)
    want = ("1", "Mortgage Loan Customer#1", "Transfer to mortgage SMALL TIN red plate", "Brand#1", "0.10", "1/1")
    names = ("bank_account_id", "bank_account_name", "txn_description", "payee", "amount", "filename")
    got = {r.txn_id: tuple(str(r[n]) for n in names) for r in rows.collect()}
    assert got == {"1-1": want, "1-1-again": want}
