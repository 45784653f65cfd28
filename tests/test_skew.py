"""Results stay whole and equal when a third of the rows share a key."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from passbook.operators import lookup
from passbook.operators.position import placed, range_sorted
from passbook.plans import marts
from testbed.ledger import Warehouse
from testbed.oracle import oracle_sql
from testbed.queries import queries
from tests.compare import TABLES, connect, difference

SOURCE = "/root/testdata/sf0.001"

SKEWED = (
    "fact_dedup",
    "accounts_latest",
    "dim_merchant",
    "expenses_detail",
    "income_detail",
    "daily_overunder",
    "mom_performance",
    "q10_rows_all_expenses",
    "quality_relationships",
    "balance_as_of",
    "trailing_snapshot",
    "stream_latest_transactions",
    "stream_first_seen",
)


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory) -> str:
    """A hot transaction id, a hot merchant and day, and a hot account."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM '{SOURCE}/{name}.parquet'")
    con.execute(
        "UPDATE lineitem SET l_orderkey = 7, l_linenumber = 1 WHERE l_suppkey % 3 = 0"
    )
    con.execute(
        "UPDATE lineitem SET l_partkey = 3, l_shipdate = TIMESTAMP '2001-03-03'"
        " WHERE l_suppkey % 3 = 1"
    )
    con.execute("UPDATE orders SET o_custkey = 5 WHERE o_orderkey % 3 = 0")
    for name in TABLES:
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", SKEWED)
def test_skewed_tables_match_the_oracle(spark, skewed_dir, monkeypatch, name):
    monkeypatch.setattr(lookup, "MIN_PIECE", 50)
    con = connect(skewed_dir)
    problem = difference(
        spark, con, name, queries()[name], oracle_sql()[name], skewed_dir
    )
    assert problem is None


def test_hot_merchant_is_spread(spark, skewed_dir, monkeypatch):
    """The hot merchant's rows are joined in many partitions, not in one."""
    monkeypatch.setattr(lookup, "MIN_PIECE", 50)
    warehouse = Warehouse(spark, skewed_dir)
    fact, merchants = warehouse.table("fact_transactions"), warehouse.table("dim_merchant")
    hot = merchants.orderBy(F.col("total_transactions").desc()).first()
    assert hot.total_transactions > 300
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (
            marts.labelled_transactions(fact, merchants)
            .where(F.col("merchant_category_key") == hot.merchant_category_key)
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1


def test_a_hot_account_and_day_spreads_over_files(spark, tmp_path):
    """A third of the rows is one account and one instant; its places are still gapless."""
    hot = F.col("id") % 3 == 0
    rows = spark.range(30_000).select(
        F.when(hot, "busy").otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("name"),
        F.when(hot, 0).otherwise(F.col("id") % 900).alias("at"),
        "id",
    )
    rows = rows.unionByName(rows.where("id % 30 = 0")).withColumn("name", F.when(F.col("name") != "a7", F.col("name")))
    with_parts = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "60"}
    before = {key: spark.conf.get(key) for key in with_parts}
    try:
        for key, value in with_parts.items():
            spark.conf.set(key, value)
        stored = range_sorted(rows, ["name"], [F.col("at").desc(), F.col("id").asc()], str(tmp_path / "sorted"))
        sizes = sorted(r["count"] for r in stored.groupBy("_file").count().collect())
        assert sizes[-1] < 10 * sizes[len(sizes) // 2]
        assert stored.where("name = 'busy'").select("_file").distinct().count() > 10
        got = placed(rows, ["name"], [F.col("at").desc(), F.col("id").asc()], "place").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    by_name: dict = {}
    for row in got:
        by_name.setdefault(row["name"], []).append((row.place, -row["at"], row.id))
    assert len(got) == 31_000
    for members in by_name.values():
        members.sort()
        assert [m[0] for m in members] == list(range(1, len(members) + 1))
        assert [m[1:] for m in members] == sorted(m[1:] for m in members)
