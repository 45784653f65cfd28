"""Passages of 13 or more words repeated from earlier documents, by a join of window
hashes that takes the place of a relative Lempel-Ziv parse.

Every document is parsed against all documents of smaller doc_id as its reference.
A word window of ``WINDOW`` words is a match when an earlier document holds the same
words.  Runs of words covered by matching windows are called factors here; no longest
match with a source position is sought, and one run may have several sources.  Both of
its ends are settled window by window.  The words of all factors are the duplicate spans.

The reference is indexed by content, so no document is compared with a block that
shares nothing with it:

1. Anchors.  Each window owns its least-hashed ``GRAM``-word gram (a minimizer), so
   equal windows own equal grams, and about one place in five is an anchor.  Anchors
   of grams that only one document holds cannot match.  The other grams go into a
   Bloom filter of at most ``FILTER_BITS`` bits, which is broadcast; a false hit, also
   in a filter that is too small for a very large corpus, costs time, not results.
2. Interior.  The windows that one anchor owns are compared at once, as one span of
   up to 21 words with its first document.
3. Boundaries.  Where a span has no earlier copy but its gram has, at factor ends and
   at chance repeats, the anchor's windows are compared one by one.

First documents are aggregations with partial minima, and answers are joins that
Spark splits where one passage is hot.  Windows are told apart by 64-bit hashes.

Cases: NULL and short texts have no windows; a NULL doc_id has no place in the order,
so such rows neither lose nor give words; rows of one doc_id are one document, which
never repeats itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.llm.tables import stored
from passbook.llm.texts import utf8
from passbook.llm.words import U64, mixed, windows, word_hashes

WINDOW = 13
GRAM = 5
FILTER_BITS = 1 << 29
BITS_PER_GRAM = 16
PAGE_BITS = 1 << 16

Rows = dict[str, np.ndarray]


class _Anchors:
    """The anchors of a block of texts and the range of windows each one owns."""

    def __init__(self, words: np.ndarray, edges: np.ndarray) -> None:
        left = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(words))
        starts = np.flatnonzero(left >= WINDOW)
        self.windows = windows(words, WINDOW)
        grams = windows(words, GRAM)
        if len(starts) == 0:
            self.first = self.last = self.text = np.zeros(0, np.int64)
            self.gram = grams[:0]
            return
        choices = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
        at = starts + choices[starts].argmin(axis=1)
        text = np.searchsorted(edges, starts, side="right") - 1
        new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
        self.text = text[new]
        self.first = starts[new]
        self.last = starts[np.append(new[1:], len(starts)) - 1]
        self.gram = grams[at[new]]

    def span_hashes(self) -> np.ndarray:
        """Both outer windows of a span overlap, so together they tell all its words."""
        ends = self.windows[self.first] * U64(0x9E3779B97F4A7C15) + self.windows[self.last]
        return mixed(ends + (self.last - self.first).astype(U64))


def _scan(docs: DataFrame, take: Callable[[_Anchors, np.ndarray], Rows], schema: str) -> DataFrame:
    """Rows that ``take`` makes of the anchors; it is given the texts' first word places."""
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [part.split() for part in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, last, words, edges in word_hashes(batch.column(1)):
                anchors = _Anchors(words, edges)
                out = take(anchors, edges)
                out["doc_id"] = ids[first:last][out.pop("text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out[name].view(np.int64) if out[name].dtype == U64 else out[name], kinds[kind])
                        for name, kind in fields
                    ],
                    names=[name for name, _ in fields],
                )

    return docs.mapInArrow(rows, schema)


def _probes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = U64(bits - 1)
    return mixed(keys ^ U64(0xA24BAED4963EE407)) & mask, mixed(keys ^ U64(0x9FB21C651E98DF25)) & mask


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for place in _probes(keys, 8 * len(bitmap)):
        found &= (bitmap[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & np.uint8(1) > 0
    return found


def _filter(grams: DataFrame) -> np.ndarray:
    """A Bloom filter of the column ``gram``: at most FILTER_BITS / 8 bytes."""
    wanted = max(grams.count(), 1) * BITS_PER_GRAM
    bits = min(max(1 << (wanted - 1).bit_length(), PAGE_BITS), FILTER_BITS)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(U64)
            at = np.unique(np.concatenate(_probes(keys, bits)))
            page, starts = np.unique(at // U64(PAGE_BITS), return_index=True)
            bounds = np.append(starts, len(at))
            data = []
            for k in range(len(page)):
                flags = np.zeros(PAGE_BITS, bool)
                flags[(at[bounds[k] : bounds[k + 1]] % U64(PAGE_BITS)).astype(np.int64)] = True
                data.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(page.astype(np.int64)), pa.array(data, pa.binary())], names=["page", "bits"]
            )

    def merged(rows: pa.Table) -> pa.Table:
        bits_ = np.zeros(PAGE_BITS // 8, np.uint8)
        for one in rows["bits"].to_pylist():
            bits_ |= np.frombuffer(one, np.uint8)
        return pa.table({"page": rows["page"][:1], "bits": pa.array([bits_.tobytes()], pa.binary())})

    pages = grams.select("gram").repartition("gram").mapInArrow(places, "page long, bits binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    size = PAGE_BITS // 8
    for page, data in pages.groupBy("page").applyInArrow(merged, "page long, bits binary").collect():
        bitmap[page * size : (page + 1) * size] = np.frombuffer(data, np.uint8)
    return bitmap


def _earlier(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``hash`` is in a smaller doc_id too, with that ``source``; and all firsts."""
    firsts = rows.groupBy("hash").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    firsts = stored(firsts.where("source < last").select("hash", "source"), "firsts")
    return rows.join(firsts, "hash").where("source < doc_id"), firsts


def factors(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` and ``count`` of matching windows, and a ``source`` document.

    Ranges of one document may touch; together they are the factors of its parse.
    """
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    context = docs.sparkSession.sparkContext

    def anchors(a: _Anchors, edges: np.ndarray) -> Rows:
        return {"gram": a.gram, "text": a.text}

    grams = _scan(texts, anchors, "gram long, doc_id long").groupBy("gram").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last")
    )
    grams = stored(grams.where("source < last").select("gram", "source"), "grams")
    repeated = context.broadcast(_filter(grams))

    def spans(a: _Anchors, edges: np.ndarray) -> Rows:
        hit = _has(repeated.value, a.gram)
        start = a.first - edges[a.text]
        rows = {"hash": a.span_hashes(), "text": a.text, "start": start, "count": a.last - a.first + 1}
        return {name: column[hit] for name, column in (rows | {"gram": a.gram}).items()}

    columns = "hash long, doc_id long, start int, count int"
    whole, _ = _earlier(_scan(texts, spans, columns))
    whole = stored(whole.select("doc_id", "start", "count", "source"), "spans")

    # Anchors without such a span whose gram an earlier document has: (gram, doc_id)
    # of all less the settled ones.
    own = _scan(texts, spans, "gram long, doc_id long, start int")
    settled = whole.select("doc_id", "start")
    open_ = own.join(grams, "gram").where("source < doc_id").join(settled, ["doc_id", "start"], "left_anti")
    unsettled = context.broadcast(_filter(stored(open_.select("gram").distinct(), "open-grams")))

    def single(a: _Anchors, edges: np.ndarray) -> Rows:
        hit = np.flatnonzero(_has(unsettled.value, a.gram))
        counts = a.last[hit] - a.first[hit] + 1
        text = np.repeat(a.text[hit], counts)
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(a.first[hit] - (ends - counts), counts)
        return {"hash": a.windows[at], "text": text, "start": at - edges[text]}

    parts, _ = _earlier(_scan(texts, single, "hash long, doc_id long, start int"))
    parts = parts.select("doc_id", "start", F.lit(1).alias("count"), "source")
    return whole.unionByName(parts)


def _kept(texts: pa.Array, starts: pa.Array, counts: pa.Array) -> pa.Array:
    data, offsets = utf8(texts)
    out = []
    rows = zip(starts.to_pylist(), counts.to_pylist(), strict=True)
    for i, (start, count) in enumerate(rows):
        words = data[offsets[i] : offsets[i + 1]].tobytes().split()
        step = np.zeros(len(words) + 1, np.int64)
        if start:
            first = np.array(start, np.int64)
            np.add.at(step, first, 1)
            np.add.at(step, first + np.array(count, np.int64) + WINDOW - 1, -1)
        covered = np.cumsum(step)[:-1] > 0
        edges = np.diff(np.append(False, covered).astype(np.int8))
        text = b" ".join([words[k] for k in np.flatnonzero(~covered)])
        out.append((len(words), int(covered.sum()), int((edges > 0).sum()), text))
    n_words, removed, runs, kept = zip(*out, strict=True) if out else ((), (), (), ())
    return pa.StructArray.from_arrays(
        [
            pa.array(n_words, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(runs, pa.int64()),
            pa.array([text.decode() for text in kept], pa.string()),
            pa.array([hashlib.sha256(text).hexdigest() for text in kept], pa.string()),
        ],
        names=["n_words", "n_removed", "n_factors", "kept_text", "kept_sha256"],
    )


_kept.__annotations__ = dict.fromkeys(["texts", "starts", "counts", "return"], pa.Array)
KEPT = "n_words long, n_removed long, n_factors long, kept_text string, kept_sha256 string"


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts, ``kept_text`` and its digest of every row of ``docs``."""
    found = factors(docs).groupBy(F.col("doc_id").alias("id")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("count").alias("counts")
    )
    texts = docs.select("doc_id", "text")
    joined = texts.join(found, texts["doc_id"] == found["id"], "left")
    kept = F.arrow_udf(_kept, KEPT)("text", "starts", "counts")
    return joined.select("doc_id", kept.alias("kept")).select("doc_id", "kept.*")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return without_repeats(docs).drop("kept_text")
