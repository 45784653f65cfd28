"""Language-model scores by online logistic mixing of hashed byte contexts.

A text, A-Z in lower case and closed by a byte that UTF-8 never holds, is coded bit by
bit.  A byte is one nibble, its place in ``FREQUENT``, or an escape nibble and its two
halves.  Four contexts predict each bit: the last 3, 4 and 6 bytes, and the bytes of the
word so far.  A context, with the nibbles of the byte so far, picks 16 of 2 ** ``SLOT_BITS``
hashed cells; cells count how often a value came, over all training texts.  At each bit the
values still possible vote with the logarithm of the odds of a one.  The votes are added
with weights from one of 60 sets, gated by the bit's place and by how many contexts were
seen; after each bit the chosen weights move against the error.  An adaptive map from (bit place, mixed odds) to what bits came refines the result.
Weights and maps start anew every ``SEGMENT`` bytes, so a score depends on the text and the
tables alone.  It is log10 of a probability; the escapes of frequent bytes are never written,
so that the probabilities of all texts add up to a little less than one.

1. Counting.  Each task counts all bits of its texts into fixed arrays and its words into a
   table that is sent on when it is full; arrays leave as compressed pages and are added
   up page by page in two steps, one page in memory at a time.  What is gathered grows
   with the texts; the votes have one size, 32 MB at four bytes a cell, and are broadcast.
2. Words.  Words of more than one ``HOT``-th of all tokens and at most ``HOT_BYTES`` bytes
   are fewer than ``HOT``, and their counts are sent to all tasks; the others meet theirs
   in a join, so the vocabulary may be of any size.  Counts are of exact words.
3. Scoring is row-local.  Segments are lanes of one array program, a bit of each at a time.

Cases: NULL counts as the empty text, whose one token is the end; a NULL doc_id is training;
repeated rows are learned and scored one by one; without training texts all slots are empty
and the base score is 0; a long text is many segments, a few hundred in memory at a time;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.llm.tables import Temporary, stored
from passbook.llm.texts import utf8
from passbook.llm.words import U64

ORDERS = (3, 4, 6)
PREDICTORS = len(ORDERS) + 1
SLOT_BITS = 21
PAGE_BITS = 15
PAGES = 1 << (SLOT_BITS - PAGE_BITS)
MERGES = 64
PRIOR = 0.1  # added to the zeros and to the ones of a slot
STEP = 16  # votes are kept as multiples of 1 / STEP

SEGMENT = 1024
LANES = 1024
TILE = 64
STEPS = 8  # nibbles of each lane that are prepared at once for mixing
LOOK_BACK = 12  # bytes before a segment that its contexts read; longest word context
END = 0xFF
FREQUENT = b" etaoinshrdlucm"  # bytes of one nibble; the choice changes costs, not validity
ESCAPE = len(FREQUENT)
PLACES = 12  # four bits of a first, an upper and a lower nibble
GATES = PLACES * (PREDICTORS + 1)
WEIGHT = 0.3
RATE = 0.01
MAP_CELLS = 33
MAP_REACH = 8.0
MAP_RATE = 0.02
LEAST = 1.0 / 65536
_HALF = np.float32(MAP_CELLS // 2)

HOT = 1_000_000
HOT_BYTES = 32
WORDS_IN_TASK = 200_000

_BASE = 0x9E3779B97F4A7C15
_SET = np.dtype(np.complex128)  # one set of four weights, moved as one item
_FIRST = np.full(256, ESCAPE, np.uint8)
_FIRST[list(FREQUENT)] = np.arange(ESCAPE)
_WHITE = np.isin(np.arange(256), [0, 9, 10, 11, 12, 13, 32]).astype(np.int32)
_SPREAD = 0xD6E8FEB86659FD93
_POWERS = np.array([pow(_BASE, i, 1 << 64) for i in range(LOOK_BACK + TILE + 1)], U64)
_INVERSES = np.array([pow(_BASE, -i, 1 << 64) for i in range(LOOK_BACK + TILE + 1)], U64)


def held_out(doc_id: Column) -> Column:
    """The tenth of the documents that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


# Lanes: segments of texts as rows of one byte matrix.


def segments(text: bytes) -> Iterator[bytes]:
    """A closed text cut up, each part after the ``LOOK_BACK`` bytes before it."""
    whole = bytes(LOOK_BACK) + text + bytes([END])
    for start in range(0, len(whole) - LOOK_BACK, SEGMENT):
        yield whole[start : start + LOOK_BACK + SEGMENT]


class Lanes:
    """Parts as rows of one byte matrix, those of most nibbles first."""

    def __init__(self, parts: list[bytes]) -> None:
        sizes = np.array([len(part) - LOOK_BACK for part in parts])
        width = LOOK_BACK + -(-int(sizes.max()) // TILE) * TILE
        data = np.zeros((len(parts), width), np.uint8)
        for row, part in zip(data, parts, strict=True):
            row[: len(part)] = np.frombuffer(part, np.uint8)
        inside = np.arange(width - LOOK_BACK) < sizes[:, None]
        escapes = (_FIRST[data[:, LOOK_BACK:]] == ESCAPE) & inside
        nibbles = sizes + 2 * np.count_nonzero(escapes, axis=1)
        self.order = np.argsort(-nibbles, kind="stable")
        self.data, self.sizes, self.nibbles = data[self.order], sizes[self.order], nibbles[self.order]

    def tiles(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each tile its bytes, which of its symbols exist, and their first nibbles."""
        for start in range(0, int(self.sizes.max()), TILE):
            tile = self.data[:, start : start + LOOK_BACK + TILE]
            inside = start + np.arange(TILE) < self.sizes[:, None]
            yield tile, inside, np.where(inside, _FIRST[tile[:, LOOK_BACK:]], 0)


def cells_of(tile: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For each predictor, the cells of the first nibble of each symbol of a tile, and of
    the upper and lower nibbles of its escaped symbols, row by row.

    A context picks 16 cells for a first nibble, 16 after an escape, and 16 after the upper
    half; the nibble's value picks one of them.  ``tile`` holds ``LOOK_BACK`` columns
    before the symbols.
    """
    wide = tile.astype(U64)
    count = tile.shape[1] - LOOK_BACK
    symbols = wide[:, LOOK_BACK:]
    pairs = (wide[:, :-1] << U64(8)) | wide[:, 1:]

    def last(order: int) -> np.ndarray:
        """The last ``order`` bytes before each symbol, as a number after the order's own."""
        key = np.full(symbols.shape, order, U64)
        for back in range(order, 1, -2):
            key = (key << U64(16)) | pairs[:, LOOK_BACK - back : LOOK_BACK - back + count]
        return (key << U64(8)) | wide[:, LOOK_BACK - 1 : -1] if order % 2 else key

    white = _WHITE[tile]
    places = np.arange(tile.shape[1], dtype=np.int32)
    after = np.maximum.accumulate(white * (places + np.int32(1)), axis=1)[:, LOOK_BACK - 1 : -1]
    ends = places[LOOK_BACK:]
    begins = np.maximum(after, ends - np.int32(LOOK_BACK))
    sums = np.zeros((len(tile), tile.shape[1] + 1), U64)
    np.cumsum((wide + U64(1)) * _POWERS[: tile.shape[1]], axis=1, out=sums[:, 1:])
    word = sums[:, LOOK_BACK:-1] - np.take_along_axis(sums, begins, axis=1)
    word *= _INVERSES.take(begins)
    word += (ends - begins).astype(U64)

    shift, four, turn, spread = U64(64 - SLOT_BITS + 4), U64(4), U64(29), U64(_SPREAD)
    escaped = first == ESCAPE
    symbol = symbols[escaped]
    upper, lower = symbol >> four, symbol & U64(15)

    def cell(tree: np.ndarray, value: np.ndarray) -> np.ndarray:
        return (((tree >> shift) << four) | value).astype(np.int32)

    for k, key in enumerate([*map(last, ORDERS), word]):
        key = key * U64(_BASE + 2 * k)
        after = key[escaped]
        after = ((after ^ (after >> turn)) + U64(1)) * spread
        whole = ((after ^ (after >> turn)) + upper) * spread
        yield cell(key, first.astype(U64)), cell(after, upper), cell(whole, lower)


# Training: counts of bits and words.


class _Counts:
    """How often each cell was met in the texts of one task."""

    def __init__(self) -> None:
        self.cells = np.zeros((PREDICTORS, 1 << SLOT_BITS), np.uint32)

    def add(self, parts: list[bytes]) -> None:
        found: list[list[np.ndarray]] = [[] for _ in range(PREDICTORS)]
        for tile, inside, first in Lanes(parts).tiles():
            for k, (cells, *halves) in enumerate(cells_of(tile, first)):
                found[k] += [cells[inside], *halves]
        for k in range(PREDICTORS):
            counts = np.bincount(np.concatenate(found[k]), minlength=1 << SLOT_BITS)
            self.cells[k] += counts.astype(np.uint32)

    def pages(self) -> Iterator[tuple[int, bytes]]:
        pack = zstandard.ZstdCompressor(level=1)
        for number, page in enumerate(self.cells.reshape(PREDICTORS * PAGES, -1)):
            if page.any():
                yield number, pack.compress(page.astype(np.int64).tobytes())


COUNTED = "page int, salt int, data binary, token binary, n long"


def _count_rows(pages: Iterable[tuple[int, bytes]], words: dict[bytes, int], salt: int) -> pa.RecordBatch:
    pages = list(pages)
    blank, none = [None] * len(pages), [None] * len(words)
    columns = {
        "page": pa.array([number for number, _ in pages] + none, pa.int32()),
        "salt": pa.array([salt] * len(pages) + none, pa.int32()),
        "data": pa.array([data for _, data in pages] + none, pa.binary()),
        "token": pa.array(blank + list(words), pa.binary()),
        "n": pa.array(blank + list(words.values()), pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _lowered(column: pa.Array) -> Iterator[bytes]:
    """Each text with A-Z in lower case; bytes leave all other characters alone."""
    data, offsets = utf8(column)
    for i in range(len(column)):
        yield data[offsets[i] : offsets[i + 1]].tobytes().lower()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, words, parts, salt = _Counts(), Counter(), [], 0
    for batch in batches:
        salt = batch.column(1)[0].as_py() if len(batch) else salt
        for text in _lowered(batch.column(0)):
            # Bytes split at the six ASCII white-space characters; b"" is the end.
            words.update(text.split())
            words[b""] += 1
            for part in segments(text):
                parts.append(part)
                if len(parts) == LANES // 2:
                    counts.add(parts)
                    parts = []
            if len(words) > WORDS_IN_TASK:
                yield _count_rows((), words, salt)
                words = Counter()
    if parts:
        counts.add(parts)
    if words:
        yield _count_rows(counts.pages(), words, salt)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Sums of pages that come sorted by number."""
    unpack, number, total = zstandard.ZstdDecompressor(), None, None
    for batch in batches:
        for page, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(unpack.decompress(data), np.int64)
            if page == number:
                total += counts
                continue
            if number is not None:
                yield number, total
            number, total = page, counts.copy()
    if number is not None:
        yield number, total


def _as_pages(rows: Iterable[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for number, data in rows:
        yield pa.RecordBatch.from_pydict(
            {"page": pa.array([number], pa.int32()), "data": pa.array([data], pa.binary())}
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    return _as_pages((number, pack.compress(total.tobytes())) for number, total in _added(batches))


def votes(counts: np.ndarray) -> np.ndarray:
    """Four votes for every cell: log odds of a one at each bit on the way to its nibble.

    The bit tree of 16 cells has 1, 2, 4 and 8 inner slots by bit; a slot that no text
    reached votes 0.
    """
    below = counts.reshape(-1, 16).astype(np.float64)
    out = np.zeros((*below.shape, 4), np.int8)
    for bit in range(4):
        halves = below.reshape(len(below), 2 << bit, -1).sum(axis=2)
        zeros, ones = halves[:, 0::2], halves[:, 1::2]
        odds = np.rint(np.log((ones + PRIOR) / (zeros + PRIOR)) * STEP)
        # An even split of texts that were seen is the least vote, not none.
        odds = np.where((odds == 0) & (zeros + ones > 0), 1, np.clip(odds, -127, 127))
        out[:, :, bit] = np.repeat(odds, 16 >> bit, axis=1)
    return out.reshape(-1, 4)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _as_pages((number, votes(total).tobytes()) for number, total in _added(batches))


def vote_tables(counted: DataFrame) -> np.ndarray:
    """The votes of all cells, four bytes each and of one size for any input."""
    pages = counted.where("page IS NOT NULL")
    once = pages.repartition("page", "salt").sortWithinPartitions("page").select("page", "data")
    once = once.mapInArrow(_merged, "page int, data binary")
    twice = once.repartition("page").sortWithinPartitions("page").mapInArrow(_voted, "page int, data binary")
    tables = np.zeros((PREDICTORS * PAGES, 1 << PAGE_BITS), np.uint32)
    for page, data in twice.collect():
        tables[page] = np.frombuffer(data, np.uint32)
    return tables.reshape(PREDICTORS, 1 << SLOT_BITS)


# Scoring: online mixing over lanes.


def _nibbles_of(group: Lanes, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By nibble and lane: the packed votes of each predictor, the kind, and the value."""
    n, longest = len(group.sizes), int(group.nibbles[0])
    # One row more takes what the tiles hold beyond the ends of their lanes.
    packed = np.empty((PREDICTORS, longest + 1, n), np.uint32)
    kinds, values = (np.zeros((longest + 1, n), np.uint8) for _ in range(2))
    lane, done = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
    for tile, inside, first in group.tiles():
        escaped = first == ESCAPE
        before = np.cumsum(escaped, axis=1)
        at = done + np.arange(TILE) + 2 * (before - escaped)
        done = done + TILE + 2 * before[:, -1:]
        at = np.where(inside, at, longest)
        rows = np.nonzero(escaped)[0]
        upper, symbol = at[escaped] + 1, tile[:, LOOK_BACK:][escaped]
        values[at, lane] = first
        for kind, value in ((1, symbol >> 4), (2, symbol & 15)):
            kinds[upper + kind - 1, rows] = kind
            values[upper + kind - 1, rows] = value
        for k, (cells, high, low) in enumerate(cells_of(tile, first)):
            packed[k][at, lane] = tables[k].take(cells)
            packed[k][upper, rows] = tables[k].take(high)
            packed[k][upper + 1, rows] = tables[k].take(low)
    return packed, kinds, values


def code_lengths(parts: list[bytes], tables: np.ndarray) -> np.ndarray:
    """-log2 of the probability of each part's symbols after what comes before.

    Sets of weights and maps are parted by the bit's place, so the four bits of a nibble
    touch none in common: one step codes a nibble of every lane and equals four steps of a
    bit.  Arrays go by lane and bit; lanes that are still running come first.
    """
    group = Lanes(parts)
    n, nibbles = len(parts), group.nibbles
    packed, kinds, values = _nibbles_of(group, tables)
    sets = np.full((n * GATES, PREDICTORS), WEIGHT, np.float32).view(_SET).ravel()
    reach = np.linspace(-MAP_REACH, MAP_REACH, MAP_CELLS)
    maps = np.tile((1 / (1 + np.exp(-reach))).astype(np.float32), n * PLACES)
    place_of = np.arange(n)[:, None] * PLACES + np.arange(4)
    scale = np.float32((MAP_CELLS - 1) / (2 * MAP_REACH))
    out = np.zeros(n)
    for start in range(0, int(nibbles[0]), STEPS):
        live = int(np.searchsorted(-nibbles, -start, side="left"))
        part = slice(start, min(start + STEPS, int(nibbles[0])))
        shape = (part.stop - part.start, live, 4)
        inputs = np.empty((*shape, PREDICTORS), np.float32)
        known = np.zeros(shape, np.int8)
        for k in range(PREDICTORS):
            found = np.ascontiguousarray(packed[k, part, :live]).view(np.int8).reshape(shape)
            inputs[..., k] = found
            known += found != 0
        inputs *= np.float32(1 / STEP)
        places = place_of[:live] + 4 * kinds[part, :live, None].astype(np.int64)
        chosen = places * (PREDICTORS + 1) + known
        middles = (places * MAP_CELLS + MAP_CELLS // 2).astype(np.int32)
        ones = np.unpackbits(values[part, :live, None] << 4, axis=2, count=4).astype(np.float32)
        told = np.ones(shape, np.float32)
        for step in range(shape[0]):
            live = int(np.searchsorted(-nibbles[:live], -(start + step), side="left"))
            x, at, one = inputs[step, :live], chosen[step, :live], ones[step, :live]
            w = sets.take(at).view(np.float32).reshape(live, 4, PREDICTORS)
            products = w * x
            mix = products[..., 0] + products[..., 1]
            mix += products[..., 2]
            mix += products[..., 3]
            p = np.exp(-mix)
            p += np.float32(1)
            np.reciprocal(p, out=p)
            x *= np.repeat((one - p) * np.float32(RATE), PREDICTORS).reshape(x.shape)
            w += x
            sets[at] = w.view(_SET)[..., 0]

            mix *= scale
            cell = np.rint(np.minimum(np.maximum(mix, -_HALF), _HALF)).astype(np.int32)
            cell += middles[step, :live]
            refined = maps.take(cell)
            p += refined
            p *= np.float32(0.5)
            told[step, :live] = np.abs(one + p - np.float32(1))
            refined += (one - refined) * np.float32(MAP_RATE)
            maps[cell] = refined
        # Mixing with a fair coin keeps certain bits from costing too much when they fail.
        told *= np.float32(1 - 2 * LEAST)
        told += np.float32(LEAST)
        whole = told[..., 0].astype(np.float64)
        for j in range(1, 4):
            whole *= told[..., j]
        inside = start + np.arange(shape[0])[:, None] < nibbles[None, : shape[1]]
        out[: shape[1]] -= np.log2(np.where(inside, whole, 1.0)).sum(axis=0)
    lengths = np.empty(n)
    lengths[group.order] = out
    return lengths


SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, score double, token binary, n long"


def _score(tables, hot, seen: int, vocabulary: int):
    """Rows of documents, then one row per word of a document that is not hot."""
    bottom = seen + 0.1 * (vocabulary + 1)

    def base_of(text: bytes) -> tuple[int, int, float, dict[bytes, int]]:
        """Tokens, hot tokens and their score, and the counts of the other words."""
        words = Counter(text.split())
        words[b""] += 1
        rare, known, total = {}, 0, 0.0
        for word, n in words.items():
            if (count := hot.value.get(word)) is None:
                rare[word] = n
            else:
                total += n * math.log10((count + 0.1) / bottom)
                known += n
        return words.total(), known, total, rare

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            done = _Rows()
            parts: list[bytes] = []
            owners: list[int] = []
            for i, text in enumerate(_lowered(batch.column(2))):
                done.add(numbers[i], ids[i], *base_of(text))
                for part in segments(text):
                    parts.append(part)
                    owners.append(done.count - 1)
                    if len(parts) == LANES:
                        done.code(owners, code_lengths(parts, tables.value))
                        parts, owners = [], []
                # Rows leave once they fill some lanes or hold many words.
                if len(parts) > LANES - LANES // 8 or len(done.rare) > LANES * 64:
                    if parts:
                        done.code(owners, code_lengths(parts, tables.value))
                        parts, owners = [], []
                    yield done.batch()
                    done = _Rows()
            if parts:
                done.code(owners, code_lengths(parts, tables.value))
            if done.count:
                yield done.batch()

    return rows


class _Rows:
    """Documents told so far, then the words of theirs whose counts a join must find."""

    def __init__(self) -> None:
        self.count = 0
        self.documents: list[tuple] = []
        self.bits: list[float] = []
        self.rare: list[tuple] = []

    def add(self, row: int, doc_id: int | None, n_tokens: int, n_known: int, base: float, rare: dict) -> None:
        self.count += 1
        self.documents.append((row, doc_id, n_tokens, n_known, base))
        self.bits.append(0.0)
        self.rare += [(row, word, n) for word, n in rare.items()]

    def code(self, owners: list[int], lengths: np.ndarray) -> None:
        for owner, length in zip(owners, lengths.tolist(), strict=True):
            self.bits[owner] += length

    def batch(self) -> pa.RecordBatch:
        scores_ = [-bits * math.log10(2) for bits in self.bits]
        documents = [(*d, score, None, None) for d, score in zip(self.documents, scores_, strict=True)]
        words = [(row, None, None, None, None, None, word, n) for row, word, n in self.rare]
        types = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.binary(), pa.int64()]
        names = [field.split()[0] for field in SCORED.split(", ")]
        columns = zip(*(documents + words), strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(column), kind) for column, kind in zip(columns, types, strict=True)], names=names
        )


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, counts of tokens, ``base_score`` and ``score`` of every row."""
    context = docs.sparkSession.sparkContext
    with Temporary() as temp:
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        learned = docs.where(~held_out(F.col("doc_id")))
        salted = learned.select("text", F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("salt"))
        counted = temp(salted.mapInArrow(_count, COUNTED), "counted")
        words = counted.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("count"))
        words = temp(words, "words")
        sums = words.agg(F.sum("count").alias("seen"), F.count(F.lit(1)).alias("vocabulary")).first()
        seen, vocabulary = sums.seen or 0, sums.vocabulary
        # Fewer than HOT words of at most HOT_BYTES bytes, whatever the size of the corpus.
        common = (F.col("count") * HOT > seen) & (F.octet_length("token") <= HOT_BYTES)
        hot = context.broadcast({bytes(r.token): r["count"] for r in words.where(common).collect()})
        tables = context.broadcast(vote_tables(counted))

        numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        found = temp(numbered.mapInArrow(_score(tables, hot, seen, vocabulary), SCORED), "scored")
        rare = found.where("token IS NOT NULL").select("row", "token", "n").join(words, "token", "left")
        count = F.coalesce("count", F.lit(0))
        bottom = F.lit(seen + 0.1 * (vocabulary + 1))
        rare = rare.groupBy("row").agg(
            F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("n") * F.log10((count + 0.1) / bottom)).alias("rare_base"),
        )
        rows = found.where("token IS NULL").drop("token", "n").join(rare, "row", "left")
        result = stored(
            rows.select(
                "doc_id",
                held_out(F.col("doc_id")).alias("held_out"),
                "n_tokens",
                (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                F.lit(seen).cast("long").alias("train_tokens"),
                (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
                "score",
            ),
            "scores",
        )
        for sent in (hot, tables):
            sent.destroy()
        return result


def op11_context_mixing(spark, sf_dir: str) -> DataFrame:
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
