"""Every registered query against its SQL statement in DuckDB."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from testbed import oracle, queries
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, duck, name):
    assert difference(spark, duck, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_every_order_is_judged(spark):
    """Not a sample of them: each date has a file, with two accounts an order if it is whole."""
    days = spark.read.parquet(f"{SF_DIR}/orders.parquet").groupBy(F.to_date("o_orderdate").alias("day")).count()
    want = {str(r.day): 2 * r["count"] for r in days.collect()}
    rows = QUERIES["snapshot_admission_by_day"](spark, SF_DIR).collect()
    for stored in ("nothing", "before", "all", "today"):
        got = {r.filename: r.n_accounts for r in rows if r.stored == stored}
        assert got.keys() == want.keys()
        assert all(n in (0, want[day]) for day, n in got.items())
    assert {r.decision for r in rows} == {"captured_today", "empty", "not_newer", "new"}


def test_entry_returns_months(spark):
    assert entry.entry(spark).count() > 12
