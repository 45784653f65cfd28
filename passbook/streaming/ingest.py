"""Snapshots as a stream: deduplicated transactions and latest balances.

Snapshots overlap by design, so a missed pull heals with the next one: ids
already stored are absorbed again without effect, missing ones are added.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from passbook.plans.star import latest_accounts, latest_transactions
from passbook.schemas import FLAT_ACCOUNT, FLAT_TRANSACTION
from passbook.session import scratch_path
from passbook.streaming.segments import FirstSeenStore, LatestStore, Segments


def transaction_store(path: str) -> LatestStore:
    """Exact latest-wins per transaction id."""
    return LatestStore(path, latest_transactions, FLAT_TRANSACTION, ("txn_id",))


def account_store(path: str) -> LatestStore:
    """Newest balance per account name."""
    return LatestStore(path, latest_accounts, FLAT_ACCOUNT, ("bank_account_name",))


def first_seen_store(path: str) -> FirstSeenStore:
    """Transactions by the first batch that held their id."""
    return FirstSeenStore(path, FLAT_TRANSACTION, "txn_id", latest_transactions, scratch_path)


def _drain(
    flat: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int, str], None]
) -> StreamingQuery:
    """Hand every batch that has arrived to ``sink``, with the stream's lasting id."""
    started, name = threading.Event(), []

    def batch_sink(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        sink(batch, batch_id, name[0])

    query = (
        flat.writeStream.foreachBatch(batch_sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    name.append(query.id)
    started.set()
    query.awaitTermination()
    return query


def absorb_available(flat: DataFrame, store: Segments, checkpoint: str) -> StreamingQuery:
    """Absorb every file that has arrived, then stop."""
    return _drain(flat, checkpoint, store.absorb)


def first_seen(spark: SparkSession, path: str) -> DataFrame:
    """All transactions first seen so far."""
    return first_seen_store(path).rows(spark)


def append_available(flat: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append transactions whose id is not stored yet, of any age, then stop."""
    store = first_seen_store(path)

    def sink(batch: DataFrame, batch_id: int, stream: str) -> None:
        store.absorb(batch, batch_id, stream)
        store.compact(batch.sparkSession)

    return _drain(flat, checkpoint, sink)


def absorb_documents(
    documents: DataFrame,
    store: Segments,
    flatten: Callable[[DataFrame], DataFrame],
    dead_letters: str,
    checkpoint: str,
) -> StreamingQuery:
    """Absorb the readable documents that have arrived; file the others with their reason.

    ``documents`` comes from ``stream_documents``.  A batch's dead letters are a folder
    named by stream and batch, so a retry replaces them, and the stream goes on.
    """

    def sink(batch: DataFrame, batch_id: int, stream: str) -> None:
        letters = batch.where("reason IS NOT NULL").select("filename", "reason")
        letters.write.mode("overwrite").parquet(f"{dead_letters}/batch={stream}-{batch_id}")
        store.absorb(flatten(batch.where("reason IS NULL")), batch_id, stream)

    return _drain(documents, checkpoint, sink)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """``filename`` and ``reason`` of every document that could not be read."""
    letters = spark.read.schema("filename string, reason string, batch string").parquet(path)
    return letters.select("filename", "reason").where(F.col("filename").isNotNull())
