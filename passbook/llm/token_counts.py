"""Token counts that follow edits, from a segment tree of pre-tokens per document.

A text's chunks between white space are its pre-tokens, and ``LEAF`` of them in a row
are a leaf with the number of their ids.  The tree above holds sums, laid out as a
heap: node k has the children 2k and 2k + 1, and node 1 the whole count.

An edit replaces a range of code points.  The leaves it touches, and those next to it
where it meets their edge, are coded again as they read after the edit; nothing else
is.  The first of them takes the new count, the others nothing, and only their
ancestors are summed again.  The new root equals the count of the whole edited text,
since the tokenizer never joins ids over white space.

Cases: NULL and empty texts have an empty tree and count 0; edits that overlap an
earlier one are skipped, and ranges are cut to the text; rows are independent, so
repeated rows and NULL doc_ids are counted like any other; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.llm.pii import hits
from passbook.llm.texts import utf8
from passbook.llm.tokens import TOKENIZER, text_ids, token_blocks
from passbook.llm.words import is_white

LEAF = 16
DIGITS = 7

RECOUNT = (
    "n_tokens long, n_tokens_before long, n_edits int, n_leaves int, n_leaves_coded int, chars_coded long"
)


def _tree(leaves: np.ndarray) -> np.ndarray:
    """Heap of sums over leaves, padded with zeros to a power of two."""
    if len(leaves) == 0:
        return np.zeros(0, np.int32)
    width = 1 << (len(leaves) - 1).bit_length()
    heap = np.zeros(2 * width, np.int32)
    heap[width : width + len(leaves)] = leaves
    while width > 1:
        heap[width // 2 : width] = heap[width : 2 * width].reshape(-1, 2).sum(axis=1)
        width //= 2
    return heap


def _update(heap: np.ndarray, leaf: int, count: int) -> None:
    node = len(heap) // 2 + leaf
    heap[node] = count
    while node > 1:
        node //= 2
        heap[node] = heap[2 * node] + heap[2 * node + 1]


def _leaf_starts(data: np.ndarray) -> np.ndarray:
    """The byte where each leaf's first pre-token begins; each leaf ends where the next begins."""
    inside = ~is_white(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    return np.flatnonzero(first)[::LEAF]


def tree(text: Column, tokenizer: str) -> Column:
    """The tree of each text, to be kept beside it."""

    def build(texts: pa.Array) -> pa.Array:
        heaps: list[np.ndarray] = []
        data, offsets = utf8(texts)
        for first, last, _, sizes, chunks in token_blocks(texts, tokenizer):
            ends = np.append(0, np.cumsum(chunks))
            sums = np.append(0, np.cumsum(sizes))
            # The coder cuts chunks more finely; leaves follow the white space of the text.
            for i in range(last - first):
                own = data[offsets[first + i] : offsets[first + i + 1]]
                heaps.append(_tree(_leaf_counts(own, sums[ends[i] : ends[i + 1] + 1])))
        lengths = np.array([len(heap) for heap in heaps], np.int64)
        flat = np.concatenate(heaps) if heaps else np.zeros(0, np.int32)
        starts = np.append(0, np.cumsum(lengths)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))

    build.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(build, "array<int>")(text)


def _leaf_counts(data: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Ids per leaf, from running sums over the coder's chunks of this text."""
    starts = _leaf_starts(data)
    if len(starts) == 0:
        return np.zeros(0, np.int64)
    inside = ~is_white(data)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    # The coder also begins a chunk at a stop or comma after an ASCII letter or digit.
    digit = (data >= 48) & (data <= 57)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    stop = (data == ord(".")) | (data == ord(","))
    begin[1:] |= stop[1:] & (digit | letter)[:-1]
    chunks_before = np.append(0, np.cumsum(begin))[np.append(starts, len(data))]
    empty = int(len(sums) - 1 - chunks_before[-1] > 0 and len(data) > 0 and is_white(data[:1])[0])
    at = chunks_before + empty  # white space at the start makes an empty first chunk
    at[-1] = len(sums) - 1
    return np.diff(sums[at])


def recount(text: Column, kept: Column, edits: Column, tokenizer: str) -> Column:
    """Struct of the counts after ``edits``, an array of (start, end, text) in code points."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    names = [part.split()[0] for part in RECOUNT.split(", ")]

    def apply(texts: pa.Array, trees: pa.Array, changes: pa.Array) -> pa.Array:
        jobs: list[tuple[int, int, str]] = []  # row, leaf, text to code
        heaps: dict[int, np.ndarray] = {}
        rows = []
        for i, (text_, heap, todo) in enumerate(
            zip(texts, trees, changes.to_pylist(), strict=True)
        ):
            before = heap[1].as_py() if heap.is_valid and len(heap.values) else 0
            rows.append([before, before, 0, 0, 0, 0])
            if not todo:
                continue
            _edit_one(i, text_.as_py() or "", heap, todo, heaps, jobs, rows[-1])
        coded = text_ids(pa.array([job[2] for job in jobs], pa.string()), tokenizer)
        for (i, leaf, text_), ids in zip(jobs, coded, strict=True):
            _update(heaps[i], leaf, len(ids))
            rows[i][0] = int(heaps[i][1])
            rows[i][5] += len(text_)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.StructArray.from_arrays(arrays, names=names)

    apply.__annotations__ = dict.fromkeys(["texts", "trees", "changes", "return"], pa.Array)
    return F.arrow_udf(apply, RECOUNT)(text, kept, edits)


def _edit_one(i, text, heap, todo, heaps, jobs, row) -> None:
    """Regions of ``text`` to code again; leaves that merge into a region become empty."""
    data = np.frombuffer(text.encode(), np.uint8)
    point = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points before each byte
    starts = point[_leaf_starts(data)]
    edges = np.append(starts, len(text))
    edges[0] = 0  # white space before the first pre-token belongs to it
    values = np.array(heap.values if len(starts) else [0, 0], np.int32)
    heaps[i] = values.copy()
    leaves = max(len(starts), 1)
    regions: list[list] = []  # first leaf, last leaf, edits
    done = 0
    for edit in sorted(todo, key=lambda e: (e["start"], e["end"])):
        start, end = max(0, edit["start"]), min(len(text), edit["end"])
        if start < done or start > end:
            continue
        done = end
        row[2] += 1
        first = int(np.searchsorted(edges[:leaves], max(start - 1, 0), side="right")) - 1
        last = int(np.searchsorted(edges[:leaves], min(end + 1, len(text)), side="right")) - 1
        first, last = max(first, 0), max(last, 0)
        if regions and first <= regions[-1][1] + 1:
            regions[-1][1] = max(last, regions[-1][1])
            regions[-1][2].append((start, end, edit["text"]))
        else:
            regions.append([first, last, [(start, end, edit["text"])]])
    row[3] = leaves
    for first, last, changes in regions:
        at, end = int(edges[first]), int(edges[last + 1]) if last + 1 < len(edges) else len(text)
        parts = []
        for start, stop, new in changes:
            parts += [text[at:start], new]
            at = stop
        parts.append(text[at:end])
        for leaf in range(first + 1, last + 1):
            _update(heaps[i], leaf, 0)
        jobs.append((i, first, "".join(parts)))
        row[4] += last - first + 1


def redactions(docs: DataFrame) -> DataFrame:
    """``docs`` with ``edits``: mail addresses and long numbers give way to a placeholder."""
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = hits(hits(found, "email"), "card")
    digits = lambda s: F.length(F.regexp_replace(s.value, "[^0-9]", ""))
    long_ = F.filter("card_hits", lambda s: digits(s) >= DIGITS)

    def edits(spans: Column, name: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.lit(name).alias("text")))

    both = F.concat(edits(F.col("email_hits"), "<email>"), edits(long_, "<number>"))
    return found.select("doc_id", "text", both.alias("edits"))


def counts_after(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Counts of every row of ``docs`` (``doc_id``, ``text``, ``edits``) after its edits."""
    kept = docs.withColumn("tree", tree(F.col("text"), tokenizer))
    told = recount(F.col("text"), F.col("tree"), F.col("edits"), tokenizer)
    return kept.select("doc_id", told.alias("told")).select("doc_id", "told.*")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return counts_after(redactions(docs), public_tokenizers.path(TOKENIZER))
