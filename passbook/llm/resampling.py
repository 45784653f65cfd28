"""Importance resampling towards a target distribution, by hashed n-grams.

A feature is a run of one to three consecutive words.  Separators collapse to single
spaces, and for each length a regular expression with boundary lookarounds, scanned with
overlapping matches, emits the spans of all n-grams; their CRC-32 picks one of
``BUCKETS`` buckets.  A bucket's gain is the log ratio of its share in the target to its
share in the documents, a document's weight the sum of the gains of its features, and
the documents of highest weight plus Gumbel noise are drawn, which is sampling without
replacement in proportion to exp(weight).

1. Documents and target are scanned once each; the buckets of every document are kept
   as 16-bit numbers in a stored table.
2. Tasks count their buckets in one array and send one number per bucket, so the
   counts and the gains are ``BUCKETS`` numbers whatever the size of the corpus.
3. Weights are row-local.  The ranks of the documents that can be drawn come from a range
   exchange by score: a row's rank is its place in its file plus the rows of all files
   before, so no task holds more than its range.

Cases: NULL and empty texts have no features and weight 0; a NULL doc_id takes its noise
from the empty string and goes behind all others of its score; repeated rows are drawn
one by one, their order among themselves being of no effect; a text of any length is
scanned whole; an empty target or table gives gains of the smoothing alone or no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.llm.tables import Temporary, stored
from passbook.llm.texts import blocks, utf8

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

# Bytes of letters and digits; UTF-8 keeps every byte of another character above 127.
_WORD_BYTES = set(b"abcdefghijklmnopqrstuvwxyz0123456789") | set(range(128, 256))
_PLAIN = bytes(b if b in _WORD_BYTES else 32 for b in bytes(range(256)).lower())
SCANS = [
    regex.compile(rb"(?<![^ ])[^ ]+" + rb" [^ ]+" * (size - 1) + rb"(?![^ ])")
    for size in range(1, LONGEST + 1)
]
ROW_OF_FILE = 33  # monotonically_increasing_id keeps the place in the partition below


def collapsed(text: bytes) -> bytes:
    """The words of a text, A-Z in lower case, with one space between them."""
    return b" ".join(text.translate(_PLAIN).split())


def feature_buckets(text: bytes) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every feature, repeats included."""
    plain = collapsed(text)
    if not plain:
        return 0, np.zeros(0, np.uint16)
    found = [
        np.fromiter(map(crc32, map(itemgetter(0), scan.finditer(plain, overlapped=True))), np.uint32)
        for scan in SCANS
    ]
    return len(found[0]), (np.concatenate(found) % BUCKETS).astype(np.uint16)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for first, last in blocks(offsets):
            rows = [feature_buckets(data[offsets[i] : offsets[i + 1]].tobytes()) for i in range(first, last)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array([words for words, _ in rows], pa.int64()),
                    pa.array([len(buckets) for _, buckets in rows], pa.int64()),
                    pa.array([buckets.tobytes() for _, buckets in rows], pa.binary()),
                ],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )


def features(texts: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``buckets`` of rows of an id and a text."""
    return texts.mapInArrow(_scanned, "doc_id long, n_words long, n_features long, buckets binary")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, offsets = utf8(batch.column(0).cast(pa.large_binary()))
        for first, last in blocks(offsets):
            # Slices start at an odd byte of the whole at times, so they are copied.
            part = np.frombuffer(data[offsets[first] : offsets[last]].tobytes(), np.uint16)
            counts += np.bincount(part, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many features fall into each bucket; at most ``BUCKETS`` numbers a task."""
    parts = rows.select("buckets").mapInArrow(_counted, "bucket long, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares, rounded down."""
    all_corpus, all_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    values = [math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target))) for s, t in pairs]
    return np.array(values, np.int64)


def weights(buckets: Column, gain: np.ndarray) -> Column:
    def summed(column: pa.Array) -> pa.Array:
        data, offsets = utf8(column.cast(pa.large_binary()))
        out = np.zeros(len(column), np.int64)
        for first, last in blocks(offsets):
            values = gain[np.frombuffer(data[offsets[first] : offsets[last]].tobytes(), np.uint16)]
            total = np.append(0, np.cumsum(values))
            edges = (offsets[first : last + 1] - offsets[first]) // 2
            out[first:last] = total[edges[1:]] - total[edges[:-1]]
        return pa.array(out)

    summed.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(summed, "long")(buckets)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel draw that the id alone decides, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((head + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, temp: Temporary) -> DataFrame:
    """``rows`` with ``place``: 1, 2, 3... by falling score, then by doc_id."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    # The last column parts repeated rows, so that equal ones spread over files.
    apart = rows.withColumn("row", F.monotonically_increasing_id())
    sorted_ = apart.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = temp(sorted_.withColumn("at", F.monotonically_increasing_id()), "by-score")
    sorted_ = sorted_.withColumn("file", F.shiftright("at", ROW_OF_FILE))
    # One row per file of the exchange.
    sizes = sorted_.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("file", "first", F.coalesce(before, F.lit(0)).alias("before"))
    placed = sorted_.join(F.broadcast(starts), "file")
    return placed.withColumn("place", F.col("at") - F.col("first") + F.col("before") + 1).drop(
        "row", "at", "file", "first", "before"
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (NULL: not drawn) of every row."""
    with Temporary() as temp:
        found = temp(features(docs.select(F.col("doc_id").cast("long"), "text")), "features")
        wanted = features(target.select(F.lit(0).cast("long"), "text"))
        gain = gains(bucket_counts(found), bucket_counts(wanted))
        weight = weights(F.col("buckets"), gain)
        scored = found.select("doc_id", "n_words", "n_features", weight.alias("weight")).withColumn(
            "score", F.col("weight") + noise(F.col("doc_id"))
        )
        scored = temp(scored, "scored")
        enough = F.col("n_words") >= least_words
        drawn = scored.where(enough).count() * percent // 100
        rank = F.when(F.col("place") <= drawn, F.col("place"))
        columns = ["doc_id", "n_features", "weight", "score"]
        eligible = ranked(scored.where(enough), temp).select(*columns, rank.alias("rank"))
        rest = scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
        return stored(eligible.unionByName(rest), "resampled")


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
