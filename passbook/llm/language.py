"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of up to three bytes.  In a context
that was seen, a symbol of count c among t occurrences of d distinct symbols costs
log2((t + d) / c) bits; an unseen symbol costs the escape, log2((t + d) / d), and
is coded in the next shorter context, at last with 8 bits.  Contexts that were not
seen are skipped free of charge.  The trees are frozen after training, so the
exact code length of a text is a sum over its bytes, and the language with the
shortest code wins.  ``score`` is that language's share of the summed 2**-bits.

Training takes a bounded sample: of the labelled rows given, for each language the
``docs_per_language`` first distinct texts in hash order of doc_id, of which texts up to
``doc_bytes`` long come first.  Rows equal in doc_id and text count as one.  Of each
text the trees read the first ``doc_bytes`` bytes, so the model and what reaches the
driver stay of one size.  The prediction reads every text whole, a text beyond
``PIECE_BYTES`` in pieces that carry the ``ORDER`` bytes before them, so memory does not
grow with a text.

Cases: a text that is NULL or has no letter is ``und`` with score 0; equal code
lengths go to the language first by name; without any training row everything is
``und``; ``rejected`` alone tells texts without a letter, so ``und`` may be a learned
label too; rows repeated or with a NULL doc_id are predicted like any other; other
columns are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.llm.texts import blocks, utf8

ORDER = 3
UNDETERMINED = "und"
LAST_RESORT_BITS = 8.0
DOCS_PER_LANGUAGE = 300
DOC_BYTES = 8192
PIECE_BYTES = 1 << 18


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` and whether each is there."""
    if len(sorted_keys) == 0:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return at, sorted_keys[at] == keys


def _keys(data: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` + 1 bytes at each place from ``ORDER`` on."""
    key = data[ORDER:].astype(np.uint32)
    for back in range(1, order + 1):
        key |= data[ORDER - back : len(data) - back].astype(np.uint32) << np.uint32(8 * back)
    return key


def _padded(texts: list[bytes]) -> bytes:
    return b"".join(bytes(ORDER) + text for text in texts)


@dataclass
class Model:
    """Frozen trees: sorted n-grams with bits and contexts with escape bits, by order."""

    languages: list[str]
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def cost(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of each key's last byte after its other bytes, by language."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), LAST_RESORT_BITS, np.float32)
        at, there = _find(self.grams[order], keys)
        out = self.bits[order][at]
        if not there.all():
            rest = np.flatnonzero(~there)
            ctx, known = _find(self.contexts[order], keys[rest] >> np.uint32(8))
            shorter = keys[rest] & np.uint32((1 << (8 * order)) - 1)
            escape = np.where(known[:, None], self.escapes[order][ctx], np.float32(0))
            out[rest] = self.cost(shorter, order - 1) + escape
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language, coded from its start on."""
        bits = np.zeros((len(texts), len(self.languages)))
        parts: list[bytes] = []
        owners: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            padded = bytes(ORDER) + text
            for start in range(0, len(text), PIECE_BYTES):
                parts.append(padded[start : start + ORDER + PIECE_BYTES])
                owners.append(i)
                size += len(parts[-1])
                if size >= PIECE_BYTES:
                    np.add.at(bits, owners, self._lengths(parts))
                    parts, owners, size = [], [], 0
        if parts:
            np.add.at(bits, owners, self._lengths(parts))
        return bits

    def _lengths(self, parts: list[bytes]) -> np.ndarray:
        """Bits of each part after its first ``ORDER`` bytes; no part is without others."""
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(part) for part in parts]) - ORDER
        starts = ends - np.array([len(part) for part in parts]) + ORDER
        cost = self.cost(_keys(data, ORDER))
        cost = np.append(cost, np.zeros((1, cost.shape[1]), np.float32), axis=0)
        edges = np.column_stack([starts, ends]).ravel()
        return np.add.reduceat(cost, edges, axis=0, dtype=np.float64)[::2]


def fit(samples: dict[str, list[bytes]]) -> Model:
    """Trees of every language in ``samples``."""
    languages = sorted(samples)
    model = Model(languages, [], [], [], [])
    if not languages:
        return model
    data = [np.frombuffer(_padded(samples[name]), np.uint8) for name in languages]
    inside = []  # places that are no padding
    for name in languages:
        marks = [np.repeat([False, True], [ORDER, len(text)]) for text in samples[name]]
        inside.append(np.concatenate(marks)[ORDER:])
    for order in range(ORDER + 1):
        seen = [
            np.unique(_keys(one, order)[mark], return_counts=True)
            for one, mark in zip(data, inside, strict=True)
        ]
        grams = np.unique(np.concatenate([keys for keys, _ in seen]))
        contexts = np.unique(grams >> np.uint32(8))
        bits = model.cost(grams & np.uint32((1 << (8 * order)) - 1), order - 1)
        escapes = np.zeros((len(contexts), len(languages)), np.float32)
        for k, (keys, counts) in enumerate(seen):
            ctx = np.searchsorted(contexts, keys >> np.uint32(8))
            total = np.bincount(ctx, counts, len(contexts))
            distinct = np.bincount(ctx, minlength=len(contexts))
            known = distinct > 0
            escapes[known, k] = np.log2((total[known] + distinct[known]) / distinct[known])
            bits[:, k] += escapes[np.searchsorted(contexts, grams >> np.uint32(8)), k]
            bits[np.searchsorted(grams, keys), k] = np.log2((total + distinct)[ctx] / counts)
        model.grams.append(grams)
        model.bits.append(bits)
        model.contexts.append(contexts)
        model.escapes.append(escapes)
    return model


def training_sample(
    labelled: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    doc_bytes: int = DOC_BYTES,
) -> DataFrame:
    """``lang`` and ``text`` of the bounded sample of rows with both and a letter.

    ``text`` is what the trees read of it, at most ``doc_bytes`` characters.  A language's
    rows are first thinned by hash to about four times the sample, so the ranking gets a
    like number of rows whatever the size of the corpus; the size of a language is a
    sketch of its distinct texts, so that repeated rows take no other's place.
    """
    usable = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    usable = usable.withColumn("version", F.xxhash64("text"))
    short = (F.octet_length("text") <= doc_bytes).alias("short")
    slim = usable.select("lang", "doc_id", "version", short)
    row = F.xxhash64("doc_id", "version")
    sizes = slim.groupBy("lang").agg(
        F.approx_count_distinct(F.when(F.col("short"), row)).alias("n_short"),
        F.approx_count_distinct(row).alias("n_all"),
    )
    # A sketch is off by a few per cent: short texts alone only where they are plainly enough.
    enough = F.col("n_short") >= 2 * docs_per_language
    share = 4.0 * docs_per_language / F.when(enough, F.col("n_short")).otherwise(F.col("n_all"))
    draw = F.pmod(F.xxhash64(F.lit("draw"), "doc_id", "version"), F.lit(1_000_000_007)) / 1_000_000_007
    # One row per language: small enough to send to every task.
    thinned = slim.join(F.broadcast(sizes), "lang").where((F.col("short") | ~enough) & (draw < share))
    key = ["lang", "doc_id", "version"]
    order = [F.col("short").desc(), F.xxhash64("doc_id").asc(), F.col("doc_id").asc(), F.col("version").asc()]
    ranked = thinned.select(*key, "short").distinct().select(
        *key, F.row_number().over(Window.partitionBy("lang").orderBy(*order)).alias("at")
    )
    # At most docs_per_language keys for each language, whatever the size of the input.
    chosen = ranked.where(F.col("at") <= docs_per_language).select(
        "lang", F.col("doc_id").alias("chosen_id"), "version"
    )
    read = usable.join(
        F.broadcast(chosen.withColumnRenamed("version", "chosen_version").withColumnRenamed("lang", "chosen_lang")),
        (F.col("lang") == F.col("chosen_lang"))
        & F.col("doc_id").eqNullSafe(F.col("chosen_id"))
        & (F.col("version") == F.col("chosen_version")),
        "left_semi",
    ).select(*key, F.left(letters("text"), F.lit(doc_bytes)).alias("text"))
    return read.groupBy(*key).agg(F.min("text").alias("text")).select("lang", "text")


def train(labelled: DataFrame, doc_bytes: int = DOC_BYTES, **bounds: int) -> Model:
    samples: dict[str, list[bytes]] = {}
    for lang, text in training_sample(labelled, doc_bytes=doc_bytes, **bounds).collect():
        samples.setdefault(lang, []).append(text.encode()[:doc_bytes])
    return fit(samples)


def letters(text: Column | str) -> Column:
    """What the trees read: lower case, each run of other characters one space.

    Digits, symbols and punctuation tell no language from another.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " ")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(text: Column, model: Model) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``rejected`` for a text column."""
    out = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    names = np.array([*model.languages, UNDETERMINED], dtype=object)

    def batch(lowered: pa.Array, letter: pa.Array) -> pa.Array:
        data, offsets = utf8(lowered)
        usable = letter.to_numpy(zero_copy_only=False).astype(bool)
        best = np.full(len(usable), len(names) - 1)
        score = np.zeros(len(usable))
        for first, last in blocks(offsets) if len(names) > 1 else ():
            texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(first, last)]
            bits = model.code_lengths(texts)
            least = bits.min(axis=1, keepdims=True)
            share = 1 / np.exp2(least - bits).sum(axis=1)
            good = usable[first:last]
            best[first:last] = np.where(good, bits.argmin(axis=1), best[first:last])
            score[first:last] = np.where(good, share, 0.0)
        fields = [pa.array(names[best], pa.string()), pa.array(score), pa.array(~usable)]
        return pa.StructArray.from_arrays(fields, fields=list(out))

    def batches(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lowered, letter in columns:
            yield batch(lowered, letter)

    batches.__annotations__ = {
        "columns": Iterator[tuple[pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    udf = F.arrow_udf(batches, "lang_pred string, score double, rejected boolean")
    return udf(letters(text), has_letter(text))


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected`` of every row."""
    learned = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))
    told = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        predict(F.col("text"), train(learned)).alias("told"),
    )
    return told.select("doc_id", "held_out", "told.lang_pred", "told.score", "told.rejected")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
