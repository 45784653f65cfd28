"""Near-duplicates by one-permutation MinHash.

A document is the set of its distinct five-word shingles, as 64-bit hashes, after
lower-casing A-Z; a shorter text is its whole word sequence as one shingle.  Two
documents are linked when their sets overlap by 75 % or more.

1. One permutation hashes each shingle into one of ``BINS`` bins, where the least
   value counts; empty bins take the value of a bin found by optimal densification
   (a hash of bin and attempt, until a full bin is hit).
2. Every row is a node of its own.  Rows with equal sets are one class, and its first
   row stands for it.
3. Each ``ROWS`` bins are one band and documents with equal bands share a bucket: a
   pair at 75 % misses all ``BINS / ROWS`` buckets with a chance of 3e-7.
4. A bucket proposes a star: its first node with each other member.  Pairs that
   a lossless bound on small bitmaps cannot rule out are compared on full sets.
5. Stars alone lose a link between two members that both differ from the centre.  So
   buckets that hold more than one component after that are compared in blocks of
   ``BLOCK`` members, across components, by the same bound and the same full sets.
   Only pairs that may really be linked come out of these blocks.
6. Connected components over all links.

Cases: a NULL or wordless text has no shingles and is linked with nothing; a NULL
doc_id is never linked, and its component is NULL; rows of one doc_id are linked only by
their own texts, so one of them may be kept and another not; texts of any length are read
whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.llm.components import components
from passbook.llm.tables import Temporary, stored
from passbook.llm.words import U64, mixed, windows, word_hashes
from passbook.operators.lookup import salted_lookup

SHINGLE = 5
BINS = 160
ROWS = 4
BLOCK = 1024
HOT_COMPONENT = 1024
SPACE = 16
LEAST_BITS, MOST_BITS = 256, 262_144
EMPTY = np.uint64(2**64 - 1)

FEATURES = "doc_id long, version long, n_shingles long, set_a long, set_b long, bits binary, bands array<long>"


def shingle_sets(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    """The sorted distinct shingle hashes of each text, a block of texts at a time."""
    for first, last, words, edges in word_hashes(texts, lower=True):
        hashes = windows(words, SHINGLE)
        found = []
        for k in range(last - first):
            start, end = edges[k], edges[k + 1]
            if end - start >= SHINGLE:
                found.append(np.unique(hashes[start : end - SHINGLE + 1]))
            else:
                found.append(windows(words[start:end], end - start) if end > start else hashes[:0])
        yield found


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One-permutation MinHash with optimal densification; one row per non-empty set."""
    sizes = np.array([len(one) for one in sets])
    permuted = mixed(np.concatenate(sets) ^ U64(0x5851F42D4C957F2D))
    at = ((permuted >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    at += np.repeat(np.arange(len(sets)) * bins, sizes)
    flat = np.full(len(sets) * bins, EMPTY)
    np.minimum.at(flat, at, mixed(permuted))
    own = flat.reshape(len(sets), bins)
    full, out = own != EMPTY, own.copy()
    row, bin_ = np.nonzero(~full)
    attempt = 0
    while len(row):
        target = (mixed(bin_.astype(U64) * U64(1 << 32) + U64(attempt)) % U64(bins)).astype(np.int64)
        hit = full[row, target]
        out[row[hit], bin_[hit]] = own[row[hit], target[hit]]
        row, bin_ = row[~hit], bin_[~hit]
        attempt += 1
    return out


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, which also tells the band's number."""
    parts = signature.reshape(len(signature), -1, rows)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=U64), parts.shape[:2]).copy()
    for row in range(rows):
        key = mixed(key * U64(0x9E3779B97F4A7C15) + parts[:, :, row])
    return key.view(np.int64)


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit per low hash value, ``SPACE`` or more bits per shingle up to ``MOST_BITS``."""
    wanted = 1 << max(0, SPACE * len(hashes) - 1).bit_length()
    size = min(max(wanted, LEAST_BITS), MOST_BITS)
    flags = np.zeros(size, bool)
    flags[(hashes & U64(size - 1)).astype(np.int64)] = True
    return np.packbits(flags).tobytes()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, versions, at = batch.column(0), batch.column(2), 0
        for sets in shingle_sets(batch.column(1)):
            full = [one for one in sets if len(one)]
            keys = iter(bands(signatures(full))) if full else iter(())
            values = [int(one.sum()) for one in sets]
            others = [int(mixed(one).sum()) for one in sets]
            signed = lambda xs: pa.array(np.array(xs, U64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, len(sets)),
                    versions.slice(at, len(sets)),
                    pa.array([len(one) for one in sets], pa.int64()),
                    signed(values),
                    signed(others),
                    pa.array([bitmap(one) for one in sets], pa.binary()),
                    pa.array([next(keys) if len(one) else [] for one in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "version", "n_shingles", "set_a", "set_b", "bits", "bands"],
            )
            at += len(sets)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, at = batch.column(0), 0
        for sets in shingle_sets(batch.column(1)):
            data = pa.array([one.tobytes() for one in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(sets)), data], names=["node", "hashes"]
            )
            at += len(sets)


def _folded(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def most_difference(size_a, size_b):
    """The symmetric difference that sets of these sizes can have at 75 % overlap."""
    return (size_a + size_b) // 7


def _may_link(a_bits: pa.Array, b_bits: pa.Array, a_size: pa.Array, b_size: pa.Array) -> pa.Array:
    """False only where the sets cannot overlap by 75 %.

    A bit set on one side only stands for a shingle on that side only, so the bits
    that differ are a lower bound of the symmetric difference, also after folding.
    """
    sizes = zip(a_size.to_pylist(), b_size.to_pylist(), strict=True)
    out = []
    for a, b, (n, m) in zip(a_bits.to_pylist(), b_bits.to_pylist(), sizes, strict=True):
        if 4 * min(n, m) < 3 * max(n, m):
            out.append(False)
            continue
        x, y = np.frombuffer(a, np.uint64)[None], np.frombuffer(b, np.uint64)[None]
        while x.shape[1] > y.shape[1]:
            x = _folded(x)
        while y.shape[1] > x.shape[1]:
            y = _folded(y)
        out.append(int(np.bitwise_count(x ^ y).sum()) <= most_difference(n, m))
    return pa.array(out, pa.bool_())


def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    """100 * intersection >= 75 * union, on the full sets."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
        if len(x) < len(y):
            x, y = y, x
        at = np.searchsorted(x, y)
        at[at == len(x)] = 0
        both = int((x[at] == y).sum())
        out.append(100 * both >= 75 * (len(x) + len(y) - both))
    return pa.array(out, pa.bool_())


def _annotated(f, count: int):
    f.__annotations__ = dict.fromkeys(f.__code__.co_varnames[:count], pa.Array) | {"return": pa.Array}
    return f


def _block_pairs(rows: pa.Table) -> pa.Table:
    """Pairs across components that may be linked, between two blocks or within one."""
    low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
    docs, comps = rows["node"].to_numpy(), rows["component"].to_numpy()
    sizes, block = rows["n_shingles"].to_numpy(), rows["block"].to_numpy()
    bucket = rows["bucket"][0].as_py()
    keys = np.array(rows["bands"].to_pylist(), np.int64)
    data = rows["bits"].to_pylist()
    widths = np.array([len(one) for one in data])
    a_out, b_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        wide = np.flatnonzero(widths == 2 * width)  # sets at 75 % differ by one step at most
        bits = np.array([np.frombuffer(data[i], np.uint64) for i in own])
        if len(wide):
            more = _folded(np.array([np.frombuffer(data[i], np.uint64) for i in wide]))
            bits = np.concatenate([bits, more])
        which = np.concatenate([own, wide])
        n, c, d, p, k = sizes[which], comps[which], docs[which], block[which], keys[which]
        for i in range(len(own)):
            rest = slice(i + 1, None)
            good = (c[rest] != c[i]) & (4 * np.minimum(n[rest], n[i]) >= 3 * np.maximum(n[rest], n[i]))
            if low != high:
                good &= p[rest] != p[i]
            at = np.flatnonzero(good) + i + 1
            if len(at):
                apart = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
                at = at[apart <= most_difference(n[at], n[i])]
                # Of all buckets of a pair, the one with the least key tells it.
                first = np.where(k[at] == k[i], k[i], np.iinfo(np.int64).max).min(axis=1)
                at = at[first == bucket]
                a_out.append(np.minimum(d[at], d[i]))
                b_out.append(np.maximum(d[at], d[i]))
    return pa.table({"a": np.concatenate(a_out), "b": np.concatenate(b_out)})


def _confirmed(pairs: DataFrame, docs: DataFrame, keys: DataFrame, temp: Temporary) -> DataFrame:
    """The pairs whose full sets are linked."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = keys.join(wanted, "node", "left_semi").select("node", "doc_id", "version")
    some = docs.join(wanted, ["doc_id", "version"]).select("node", "text")
    sets = some.mapInArrow(_sets, "node long, hashes binary")
    # Rows repeated in full give a node its text more than once.
    sets = temp(sets.groupBy("node").agg(F.any_value("hashes").alias("hashes")), "sets")
    linked = F.arrow_udf(_annotated(_linked, 2), "boolean")
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("b_set")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("hashes").alias("a_set")), "a"
    )
    return temp(both.where(linked("a_set", "b_set")).select("a", "b"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``version``, ``n_shingles``, ``component_id``, ``kept`` and ``stays`` of every row.

    ``version`` is ``xxhash64(text)``.  ``kept`` tells the rows of the component's smallest
    doc_id; of these, ``stays`` tells the one version that stands for the component.
    """
    with Temporary() as temp:
        docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
        every = docs.mapInArrow(_features, FEATURES).withColumn("node", F.monotonically_increasing_id())
        # All features go as soon as the representatives' are stored.
        with Temporary() as first:
            every = first(every, "features")
            rows = stored(every.select("node", "doc_id", "version", "n_shingles"), "sizes")
            usable = every.where("n_shingles > 0 AND doc_id IS NOT NULL")
            classes = usable.groupBy("n_shingles", "set_a", "set_b").agg(F.min("node").alias("rep"))
            classes = first(classes, "classes")
            same = ["n_shingles", "set_a", "set_b"]
            member = temp(usable.select("node", *same).join(classes, same).select("node", "rep"), "members")
            reps = classes.select(F.col("rep").alias("node"))
            features = usable.join(reps, "node", "left_semi").select("node", "n_shingles", "bits", "bands")
            features = temp(features, "representatives")

        banded = features.select("node", F.explode("bands").alias("bucket"))
        full = banded.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("node").alias("hub"),
            F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("content"),
        )
        # Buckets with the same members count once, as the one with the least key.
        full = full.where("n > 1").groupBy("n", "hub", "content").agg(F.min("bucket").alias("bucket"))
        full = temp(full.select("bucket", "n", "hub"), "buckets")
        shared = temp(banded.join(full, "bucket"), "shared-buckets")

        star = shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
        sketch = features.select("node", "n_shingles", "bits")
        side = lambda s: sketch.select(
            F.col("node").alias(s), F.col("n_shingles").alias(f"{s}_n"), F.col("bits").alias(f"{s}_bits")
        )
        may_link = F.arrow_udf(_annotated(_may_link, 4), "boolean")
        compared = star.distinct().join(side("b"), "b").join(side("a"), "a")
        likely = compared.where(may_link("a_bits", "b_bits", "a_n", "b_n")).select("a", "b")
        links = _confirmed(temp(likely, "star-pairs"), docs, rows, temp)

        found = components(links)
        placed = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        placed = temp(placed.select("bucket", "n", "node", "component"), "placed")
        mixed_ones = placed.groupBy("bucket").agg(
            F.min("component").alias("least"), F.max("component").alias("most")
        )
        open_ = temp(mixed_ones.where("least < most").select("bucket"), "open-buckets")
        parts = F.ceil(F.col("n") / BLOCK).cast("int")
        blocks_ = (
            placed.join(open_, "bucket")
            .join(features, "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), parts).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .select(
                "bucket",
                F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high"),
                "node",
                "component",
                "n_shingles",
                "block",
                "bits",
                "bands",
            )
        )
        rest = blocks_.groupBy("bucket", "low", "high").applyInArrow(_block_pairs, "a long, b long")
        more = _confirmed(temp(rest.distinct(), "rest-pairs"), docs, rows, temp)
        again = components(
            more.unionByName(links).unionByName(
                member.where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
            )
        )
        linked = temp(rows.join(again, "node"), "linked")
        heads = linked.groupBy("component").agg(
            F.min(F.struct("doc_id", "version")).alias("head"), F.count(F.lit(1)).alias("n_rows")
        )
        heads = temp(heads, "heads")
        # A component may hold much of all rows, so its rows meet its head over salts.
        named = salted_lookup(linked, heads, ["component"], "n_rows", "node", min_piece=HOT_COMPONENT)
        own = F.struct("doc_id", "version")
        named = named.select(
            "doc_id", "version", "n_shingles", F.col("head.doc_id").alias("component_id"),
            (F.col("doc_id") == F.col("head.doc_id")).alias("kept"), (own == F.col("head")).alias("stays"),
        )
        alone = rows.join(again, "node", "left_anti").select(
            "doc_id", "version", "n_shingles", F.col("doc_id").alias("component_id"),
            F.lit(True).alias("kept"), F.lit(True).alias("stays"),
        )
        return stored(named.unionByName(alone), "near-duplicates")


def op4_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
