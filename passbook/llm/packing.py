"""Packing token pieces into sequences by vector best-fit.

A document's ids end with one separator id.  Only documents longer than a sequence
are cut.  Pieces are packed longest first.  Each open sequence has a vector of
residual capacities: tokens, documents and attention cost (the sum of squared
lengths).  A piece goes to a sequence that can take it under all three: of all open
ones the one with the smallest weighted norm of what would remain, or with the largest
weighted dot product of demand and residual; of equal ones the tightest in tokens, then
the one that was filled last.

The pieces are only numbers here, about 30 bytes each.  They are dealt at random
over groups of about ``GROUP_PIECES``, each packed in one task, so a task's memory
is bounded and the loss is at most about one part-filled sequence per group.

Cases: NULL or empty text is the separator alone; rows repeated are packed each
for itself; an empty table gives an empty result; a piece that no open sequence
can take opens one; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.llm.tables import stored
from passbook.llm.tokens import IDS, TOKENIZER, text_ids

SEQUENCE_TOKENS = 4096
SEPARATOR = 1
GROUP_PIECES = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, and the weight of each share in the choice.

    The defaults of documents and attention bind no sequence of ``tokens`` tokens.
    """

    tokens: int = SEQUENCE_TOKENS
    documents: int = SEQUENCE_TOKENS
    attention: int = SEQUENCE_TOKENS**2
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"


def pieces(docs: DataFrame, tokenizer: str, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece of each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(
                batch.column(0).to_pylist(), text_ids(batch.column(1), tokenizer), strict=True
            ):
                whole = np.append(ids, IDS.type(SEPARATOR))
                for piece, start in enumerate(range(0, len(whole), tokens)):
                    part = whole[start : start + tokens]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


class _Bins:
    """Open sequences in ascending order of residual tokens, for up to ``most`` pieces."""

    def __init__(self, capacity: Capacity, most: int) -> None:
        self.capacity = capacity
        # Residual tokens, documents and attention cost, and the number of the sequence.
        self.open = np.zeros((4, most), np.int64)
        self.size = 0
        self.opened = 0

    def _best(self, first: int, length: int) -> int | None:
        """Place of the best sequence for a piece, of all from ``first`` on, where tokens suffice."""
        top, w = self.capacity, self.capacity.weights
        limits, demand = (top.tokens, top.documents, top.attention), (length, 1, length * length)
        residual = self.open[:3, first : self.size]
        if top.rule == "dot":
            scores = -sum(a * (b / n) * (c / n) for a, b, c, n in zip(w, residual, demand, limits, strict=True))
        else:
            scores = sum(a * ((b - c) / n) ** 2 for a, b, c, n in zip(w, residual, demand, limits, strict=True))
        scores[(residual[1] < 1) | (residual[2] < demand[2])] = np.inf
        best = int(np.argmin(scores))
        return first + best if scores[best] < np.inf else None

    def put(self, length: int) -> tuple[int, int]:
        """Sequence number and offset there of a piece of ``length`` tokens."""
        top, cost, rows = self.capacity, length * length, self.open
        first = int(np.searchsorted(rows[0, : self.size], length))
        best = self._best(first, length) if first < self.size else None
        if best is None:
            left, documents, attention, number = top.tokens, top.documents, max(top.attention, cost), self.opened
            self.opened += 1
        else:
            left, documents, attention, number = rows[:, best].tolist()
            rows[:, best : self.size - 1] = rows[:, best + 1 : self.size]
            self.size -= 1
        # One that is full, in tokens or documents, can take no more.
        if left > length and documents > 1:
            at = int(np.searchsorted(rows[0, : self.size], left - length))
            rows[:, at + 1 : self.size + 1] = rows[:, at : self.size]
            rows[:, at] = left - length, documents - 1, attention - cost, number
            self.size += 1
        return number, top.tokens - left


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, packed longest first."""
    bins = _Bins(capacity, len(lengths) + 1)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        sequence[i], offset[i] = bins.put(int(lengths[i]))
    return sequence, offset


def pack(parts: DataFrame, capacity: Capacity = Capacity(), count: int | None = None) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``; ``length`` is at most ``capacity.tokens``.

    ``count`` is the number of rows, if known.
    """
    groups = -(-(parts.count() if count is None else count) // GROUP_PIECES)

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = best_fit(rows["length"].to_numpy(), capacity)
        group = rows["pack_group"].to_numpy()
        rows = rows.drop_columns(["pack_group"])
        rows = rows.append_column("sequence_id", pa.array(sequence * groups + group))
        return rows.append_column("offset", pa.array(offset))

    group = F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(max(groups, 1))).alias("pack_group")
    schema = parts.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    return parts.select("*", group).groupBy("pack_group").applyInArrow(
        packed, f"{schema.replace(',', ', ')}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity()
) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(stored(pieces(docs, tokenizer, capacity.tokens), "pieces"), capacity)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))
