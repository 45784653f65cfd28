"""Token ids on disk in training order, as shards of fixed stride.

A sequence is a piece of at most ``stride`` ids of one document, which ends with the
separator id; ids are little-endian unsigned 16-bit numbers and short pieces are
padded.  A keyed Feistel permutation with cycle-walking gives each of the N sequences
one of the slots 0..N-1, so the order is random, needs no sort key to be stored, and
can be computed from a sequence's number alone.  Slots are range-partitioned into
shards of ``slots`` sequences, and each shard is one row with one payload, where slot
s begins at byte (s - first_slot) * stride * 2.  Shards are ordinary Parquet rows, so a
lost executor or a broken write leaves no half shard, in any store Spark can write.

A sequence's number is its task's offset plus its place in the task; both are stored
with the pieces before slots are given, so a recomputed task cannot change them.

Cases: NULL or empty text is one sequence with the separator alone; rows repeated are
sequences of their own; a NULL doc_id is kept; an empty table gives no shard; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passbook.llm.tables import stored
from passbook.llm.tokens import TOKENIZER, text_ids
from passbook.llm.words import U64, mixed

STRIDE = 512
SLOTS = 2048
SEPARATOR = 1
KEY = 20240229
ROUNDS = 6
DISK_IDS = np.dtype("<u2")

SHARDS = (
    "shard long, first_slot long, n_sequences int, stride int, payload binary,"
    " payload_crc32 long, doc_ids array<long>, pieces array<int>, lengths array<int>"
)


def permuted(index: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """The slot of each index in 0..size-1, a bijection told by ``key``."""
    half = U64(max(1, -(-max(size - 1, 1).bit_length() // 2)))
    mask = (U64(1) << half) - U64(1)
    keys = mixed(np.arange(ROUNDS, dtype=U64) + U64(key) * U64(ROUNDS))
    out = index.astype(U64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for round_key in keys:
            left, right = right, left ^ (mixed(right ^ round_key) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= U64(size)]
    return out.astype(np.int64)


def slot_of(index: Column, size: int, key: int = KEY) -> Column:
    def slots(numbers: pa.Array) -> pa.Array:
        return pa.array(permuted(numbers.to_numpy(), size, key))

    slots.__annotations__ = {"numbers": pa.Array, "return": pa.Array}
    return F.arrow_udf(slots, "long")(index)


def sequences(docs: DataFrame, tokenizer: str, stride: int = STRIDE) -> DataFrame:
    """``doc_id``, ``piece`` and ``ids`` of each sequence."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, numbers, parts = [], [], []
            texts = text_ids(batch.column(1), tokenizer)
            for doc_id, ids in zip(batch.column(0).to_pylist(), texts, strict=True):
                whole = np.append(ids, ids.dtype.type(SEPARATOR)).astype(DISK_IDS)
                for piece, start in enumerate(range(0, len(whole), stride)):
                    doc_ids.append(doc_id)
                    numbers.append(piece)
                    parts.append(whole[start : start + stride].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())],
                names=["doc_id", "piece", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, ids binary")


def _numbered(pieces: DataFrame) -> tuple[DataFrame, int]:
    """``pieces``, stored, with ``number`` 0..N-1, and N."""
    place = F.monotonically_increasing_id().alias("place")
    kept = stored(pieces.select("*", F.spark_partition_id().alias("task"), place), "sequences")
    tasks = kept.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    # One row per task of the scan.
    before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(tasks.select("task", "first", before.alias("before"), "n"), "task-offsets")
    total = offsets.agg(F.sum("n")).first()[0] or 0
    number = F.col("before") + F.col("place") - F.col("first")
    numbered = kept.join(F.broadcast(offsets.drop("n")), "task")
    return numbered.select("doc_id", "piece", "ids", number.alias("number")), total


def _shards(stride: int, slots: int):
    width = stride * DISK_IDS.itemsize

    def row(shard: int, rows: list[tuple]) -> dict:
        payload = b"".join(ids.ljust(width, b"\0") for *_, ids in rows)
        return {
            "shard": shard,
            "first_slot": shard * slots,
            "n_sequences": len(rows),
            "stride": stride,
            "payload": payload,
            "payload_crc32": zlib.crc32(payload),
            "doc_ids": [doc_id for doc_id, _, _ in rows],
            "pieces": [piece for _, piece, _ in rows],
            "lengths": [len(ids) // DISK_IDS.itemsize for *_, ids in rows],
        }

    kinds = pa.schema(
        [
            ("shard", pa.int64()),
            ("first_slot", pa.int64()),
            ("n_sequences", pa.int32()),
            ("stride", pa.int32()),
            ("payload", pa.binary()),
            ("payload_crc32", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("pieces", pa.list_(pa.int32())),
            ("lengths", pa.list_(pa.int32())),
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for shard, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if shard != now and rows:
                    yield pa.RecordBatch.from_pylist([row(now, rows)], kinds)
                    rows = []
                now = shard
                rows.append(tuple(rest))
        if rows:
            yield pa.RecordBatch.from_pylist([row(now, rows)], kinds)

    return build


def training_order(
    docs: DataFrame, tokenizer: str, stride: int = STRIDE, slots: int = SLOTS, key: int = KEY
) -> DataFrame:
    """The shards, one row each; ids need a vocabulary of at most 65,536."""
    numbered, total = _numbered(sequences(docs, tokenizer, stride))
    placed = numbered.withColumn("slot", slot_of(F.col("number"), max(total, 1), key))
    placed = placed.withColumn("shard", F.expr(f"slot div {slots}"))
    parts = max(1, min(-(-total // slots), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    ordered = placed.repartitionByRange(parts, "shard").sortWithinPartitions("shard", "slot")
    return ordered.select("shard", "doc_id", "piece", "ids").mapInArrow(_shards(stride, slots), SHARDS)


def write_shards(shards: DataFrame, path: str) -> None:
    shards.write.mode("overwrite").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int = 0) -> DataFrame:
    """``slot`` and ``ids`` from a slot on, in order: where a run stopped, it resumes."""
    shards = spark.read.parquet(path)
    shards = shards.where(F.col("first_slot") + F.col("n_sequences") > slot)
    at = F.posexplode("lengths").alias("at", "length")
    each = shards.select("first_slot", "stride", "payload", "doc_ids", "pieces", at)
    width = F.col("stride") * DISK_IDS.itemsize
    ids = F.substring("payload", F.col("at") * width + 1, F.col("length") * DISK_IDS.itemsize)
    out = each.select(
        (F.col("first_slot") + F.col("at")).alias("slot"),
        F.get("doc_ids", F.col("at")).alias("doc_id"),
        F.get("pieces", F.col("at")).alias("piece"),
        ids.alias("ids"),
    )
    return out.where(F.col("slot") >= slot).orderBy("slot")


def op3_token_output(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return training_order(docs, public_tokenizers.path(TOKENIZER))
