"""Streams give the batch result whatever the order of arrival."""

from __future__ import annotations

import pytest

from passbook.plans import star
from passbook.sources.snapshots import (
    flatten_accounts,
    flatten_transactions,
    read_snapshots,
    stream_documents,
    stream_snapshots,
)
from passbook.streaming.ingest import (
    absorb_available,
    absorb_documents,
    account_store,
    append_available,
    first_seen,
    first_seen_store,
    read_dead_letters,
    transaction_store,
)
from tests.plan import plan_of
from tests.rows import account, flat, flat_row, txn, write_snapshot

JAN = txn("t1", "2026-01-10T12:00:00", "-1.00", "shop", "S")
FEB = txn("t2", "2026-02-10T12:00:00", "-2.00", "shop", "S")
PENDING = txn("t3", "2026-02-11T12:00:00", "-3.00", "pending", "S")
POSTED = txn("t3", "2026-02-12T12:00:00", "-3.50", "posted", "S")
MAR = txn("t4", "2026-03-10T12:00:00", "-4.00", "shop", "S")

SNAPSHOTS = {
    "2026-01-31T23:00:00": [JAN],
    "2026-02-11T23:00:00": [JAN, FEB, PENDING],
    "2026-03-15T23:00:00": [JAN, FEB, POSTED, MAR],
}


def pull(root, as_of):
    write_snapshot(root, as_of, [account("Checking", as_of[5:7], as_of, SNAPSHOTS[as_of])])


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_stores_equal_the_batch_result(spark, tmp_path, order):
    root = tmp_path / "raw"
    times = list(SNAPSHOTS)
    txns = transaction_store(str(tmp_path / "txns"))
    balances = account_store(str(tmp_path / "balances"))
    for step, index in enumerate(order):
        pull(root, times[index])
        stream = stream_snapshots(spark, str(root))
        absorb_available(flatten_transactions(stream), txns, str(tmp_path / "c1"))
        absorb_available(flatten_accounts(stream), balances, str(tmp_path / "c2"))
        raw = read_snapshots(spark, str(root))
        want = star.latest_transactions(flatten_transactions(raw))
        assert rows(txns.current(spark)) == rows(want)
        if step == 1:
            txns.compact(spark, fan_in=2)
            txns.compact(spark, fan_in=2)  # nothing new: no second merge
            assert len(txns._live(spark)) == 1
            assert rows(txns.current(spark)) == rows(want)
    want = star.latest_accounts(flatten_accounts(read_snapshots(spark, str(root))))
    assert rows(balances.current(spark)) == rows(want)
    assert balances.current(spark).first().bank_account_id == "id-1"
    kept = {r.txn_id: r.txn_description for r in txns.current(spark).collect()}
    assert kept["t3"] == "posted"


def test_retried_batch_changes_nothing(spark, tmp_path):
    root = tmp_path / "raw"
    for as_of in SNAPSHOTS:
        pull(root, as_of)
    flat = flatten_transactions(read_snapshots(spark, str(root)))
    store = transaction_store(str(tmp_path / "store"))
    store.absorb(flat, 0)
    before = rows(store.current(spark))
    store.absorb(flat, 0)
    store.absorb(flat.limit(2), 1)  # an overlapping batch
    assert rows(store.current(spark)) == before


def test_empty_store_reads_as_no_rows(spark, tmp_path):
    store = transaction_store(str(tmp_path / "store"))
    assert store.current(spark).count() == 0
    store.compact(spark)
    assert first_seen(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("merge", [False, True])
def test_second_checkpoint_adds_to_the_first(spark, tmp_path, merge):
    store = transaction_store(str(tmp_path / "store"))
    for number, as_of in enumerate(SNAPSHOTS):
        root = tmp_path / f"raw{number}"
        pull(root, as_of)
        stream = flatten_transactions(stream_snapshots(spark, str(root)))
        absorb_available(stream, store, str(tmp_path / f"c{number}"))
        if merge:
            store.compact(spark, fan_in=2)
    assert {r.txn_id for r in store.current(spark).collect()} == {"t1", "t2", "t3", "t4"}


def test_merge_that_broke_off_is_not_read(spark, tmp_path):
    root = tmp_path / "raw"
    for as_of in SNAPSHOTS:
        pull(root, as_of)
    flat = flatten_transactions(read_snapshots(spark, str(root)))
    store = transaction_store(str(tmp_path / "store"))
    store.absorb(flat, 0)
    before = rows(store.current(spark))
    # Covers are written first, then rows, then the mark that the write has ended.
    spark.createDataFrame([("level0-direct-0",)], "name string").write.parquet(
        str(tmp_path / "store/covers/level1-x")
    )
    broken = str(tmp_path / "store/segments/level1-x")
    flat.limit(1).write.parquet(broken)
    (tmp_path / "store/segments/level1-x/_SUCCESS").unlink()
    assert rows(store.current(spark)) == before


def test_first_seen_is_unique_and_takes_late_windows(spark, tmp_path):
    root = tmp_path / "raw"
    times = list(SNAPSHOTS)
    for index in (2, 0, 1):  # January arrives after March
        pull(root, times[index])
        stream = stream_snapshots(spark, str(root))
        append_available(
            flatten_transactions(stream), str(tmp_path / "out"), str(tmp_path / "ckpt")
        )
    ids = [r.txn_id for r in first_seen(spark, str(tmp_path / "out")).collect()]
    assert sorted(ids) == ["t1", "t2", "t3", "t4"]


def numbered(spark, first, count):
    return flat(spark, [flat_row(f"id-{k}", "2026-01-01T00:00:00", "1.00") for k in range(first, first + count)])


def test_current_and_compact_need_no_exchange(spark, tmp_path):
    store = transaction_store(str(tmp_path / "store"))
    for number in range(4):
        store.absorb(numbered(spark, 50 * number, 80), number)
    current = store.current(spark)
    assert "Exchange" not in plan_of(current) and "Bucketed: true" in plan_of(current)
    before = rows(current)
    assert len(before) == 230
    store.compact(spark)
    assert len(store._live(spark)) == 1
    assert rows(store.current(spark)) == before
    store.absorb(numbered(spark, 500, 10), 9)
    assert "Exchange" not in plan_of(store.current(spark)) and store.current(spark).count() == 240


def scanned(store, spark, batch):
    """Bytes of the stored files that a batch has to look into."""
    live = store._live(spark)
    finest = max(store._parts(store._level(name)) for name in live)
    touched = {r.b for r in batch.select(store._bucket(finest).alias("b")).distinct().collect()}
    files = store.known(spark, live, touched).select("_metadata.file_path", "_metadata.file_size").distinct()
    return sum(r.file_size for r in files.collect())


def test_a_small_batch_reads_as_much_of_a_tenfold_store(spark, tmp_path):
    """A batch of two ids after 4, 16 and 64 batches of equal size."""
    store = first_seen_store(str(tmp_path / "seen"))
    small, read = numbered(spark, 7, 2), {}
    for number in range(64):
        store.absorb(numbered(spark, 400 * number, 500), number)  # a fifth is known
        store.compact(spark)
        if number + 1 in (4, 16, 64):
            read[number + 1] = scanned(store, spark, small)
    total = store.rows(spark)
    assert total.count() == total.select("txn_id").distinct().count() == 400 * 63 + 500
    whole = total.select("_metadata.file_path", "_metadata.file_size").distinct()
    assert read[64] <= 1.5 * read[4] and read[64] < sum(r.file_size for r in whole.collect()) / 10


def test_first_seen_batches_can_be_retried_after_a_merge(spark, tmp_path):
    store = first_seen_store(str(tmp_path / "seen"))
    for number in range(5):
        store.absorb(numbered(spark, 30 * number, 40), number)
    store.compact(spark)
    for number in range(5):
        store.absorb(numbered(spark, 30 * number, 40), number)
    assert store.rows(spark).count() == 160


def test_unreadable_documents_go_to_dead_letters(spark, tmp_path):
    root = tmp_path / "raw"
    for as_of in SNAPSHOTS:
        pull(root, as_of)
    day = root / "transactions/2026/04/01"
    day.mkdir(parents=True)
    whole = next((root / "transactions").rglob("*.json")).read_text()
    bad = {"cut": whole[: len(whole) // 2], "empty": " \n", "other": '{"rows": []}', "list": "[1, 2", "errors": '{"errors": ["x"]}'}
    for name, text in bad.items():
        (day / f"{name}.json").write_text(text)
    store = transaction_store(str(tmp_path / "store"))
    letters, checkpoint = str(tmp_path / "dead"), str(tmp_path / "ckpt")
    for _ in range(2):  # the second run finds nothing new
        absorb_documents(stream_documents(spark, str(root)), store, flatten_transactions, letters, checkpoint)
    told = {r.filename.split("/")[-1][:-5]: r.reason for r in read_dead_letters(spark, letters).collect()}
    assert told == {"cut": "not json", "empty": "empty", "other": "no accounts", "list": "not json", "errors": "no accounts"}
    assert {r.txn_id for r in store.current(spark).collect()} == {"t1", "t2", "t3", "t4"}
