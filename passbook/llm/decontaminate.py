"""Benchmark decontamination with a distributed positional inverted index.

Test items are cut into windows of ``WINDOW`` words (a shorter item is one window).

1. Count every test term in the corpus; the two rarest terms of each window stand
   for it.  A window with a term that the corpus lacks cannot occur.
2. Postings (term, document, place) of those terms only are the stored index.
3. A posting less the term's place in the item is an alignment of item and document.
   The offset-adjusted lists of a window's two terms are intersected.
4. What is left is compared word by word, for exact phrases, within blocks of ``BLOCK``
   words of the document, so a text is split once and no comparison carries all of it.
5. The looser match, from the same postings: items with a window whose two terms are at
   most ``WINDOW`` words apart somewhere in the document (``n_near_items``).  Where both
   are one word it must be there twice; the term of a one-word window must be there.

Everything is DataFrame functions.  Terms of the test set are broadcast after a check
of their size, else joined by shuffle.  Counts have partial sums; a frequent term is
picked only by windows that have no rarer one, and each document checks its own
alignments, so a passage that many documents share stays spread over them.

Cases: NULL and wordless texts have no words and no hits; an item without words is
never found; repeated rows get the same result each; rows of one doc_id with other
texts are judged each for itself; a text of any length is read whole; an item with a NULL item_id marks words but is not
listed; empty tables give no hits or no rows; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.llm.tables import Temporary, stored

WINDOW = 13
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 32 << 20
BLOCK = 1024


def words(text: Column) -> Column:
    """Words of a text, with A-Z lowered and nothing else."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, NOT_WORD), "")


def small(terms: DataFrame, column: str) -> DataFrame:
    """``terms``, marked for broadcast if its strings are within ``BROADCAST_BYTES``."""
    size = terms.agg(F.sum(F.octet_length(column) + 64)).scalar()
    fits = terms.sparkSession.range(1).select(F.coalesce(size, F.lit(0))).first()[0] <= BROADCAST_BYTES
    return F.broadcast(terms) if fits else terms


def _items(benchmark: DataFrame, keep) -> DataFrame:
    """Distinct items: ``item`` (a key), ``item_id``, ``item_words``, ``size`` of a window."""
    found = benchmark.select("item_id", words(F.col("text")).alias("item_words")).distinct()
    found = found.where(F.size("item_words") > 0).select(
        F.xxhash64("item_id", "item_words").alias("item"),
        "item_id",
        "item_words",
        F.least(F.size("item_words"), F.lit(WINDOW)).alias("size"),
    )
    return keep(found, "items")


def _documents(docs: DataFrame) -> DataFrame:
    """``key`` tells apart rows of one doc_id that have other texts."""
    key = F.struct("doc_id", F.xxhash64("text").alias("version")).alias("key")
    return docs.select(key, words(F.col("text")).alias("doc_words"))


def _anchors(items: DataFrame, documents: DataFrame, keep) -> DataFrame:
    """For each window its two rarest terms and their places in the item."""
    vocabulary = items.select(F.explode("item_words").alias("term")).distinct()
    vocabulary = small(keep(vocabulary, "terms"), "term")
    seen = documents.select(F.explode("doc_words").alias("term")).join(vocabulary, "term")
    counts = keep(seen.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    windows = items.select(
        "item",
        "size",
        "item_words",
        F.explode(F.sequence(F.lit(0), F.size("item_words") - F.col("size"))).alias("start"),
    )
    terms = windows.select(
        "item",
        "start",
        "size",
        F.posexplode(F.slice("item_words", F.col("start") + 1, F.col("size"))).alias("at", "term"),
    ).join(counts, "term")
    of_window = Window.partitionBy("item", "start")
    ranked = terms.select(
        "*",
        F.count(F.lit(1)).over(of_window).alias("found"),
        F.row_number().over(of_window.orderBy("n", "term", "at")).alias("rank"),
    ).where("found = size AND rank <= 2")
    place = F.col("start") + F.col("at")
    anchors = ranked.groupBy("item", "start", "size").agg(
        F.min(F.struct("rank", place.alias("place"), "term")).alias("one"),
        F.max(F.struct("rank", place.alias("place"), "term")).alias("two"),
    )
    return keep(anchors, "anchors")


def postings(documents: DataFrame, terms: DataFrame, keep=stored) -> DataFrame:
    """The positional index: ``term``, ``key`` and ``pos`` of each given term."""
    all_ = documents.select("key", F.posexplode("doc_words").alias("pos", "term"))
    return all_.join(small(keep(terms.distinct(), "terms"), "term"), "term")


def _alignments(index: DataFrame, anchors: DataFrame, which: str) -> DataFrame:
    """Where a window would start in a document, by one of its terms."""
    wanted = anchors.select("item", "start", "size", f"{which}.term", f"{which}.place")
    return index.join(wanted, "term").select(
        "key", "item", "start", "size", (F.col("pos") - F.col("place")).alias("shift")
    )


def _blocks(texts: DataFrame) -> DataFrame:
    """``key``, ``block`` and its words: ``BLOCK`` of them and what a window there may need."""
    # The lambda binds the words, so a text is split once and not once for each block.
    numbers = lambda w: F.sequence(F.lit(0), F.floor(F.size(w) / BLOCK).cast("int"))
    cut = lambda w: F.transform(
        numbers(w),
        lambda b: F.struct(b.alias("block"), F.slice(w, b * BLOCK + 1, BLOCK + WINDOW - 1).alias("block_words")),
    )
    parts = F.transform(F.array(words(F.col("text"))), cut)[0]
    return texts.select("key", F.inline(parts))


def _index(docs: DataFrame, benchmark: DataFrame, keep) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Test items, anchors of their windows, and the postings of the anchors' terms."""
    items, documents = _items(benchmark, keep), _documents(docs)
    anchors = _anchors(items, documents, keep)
    terms = anchors.select("one.term").union(anchors.select("two.term"))
    return items, anchors, keep(postings(documents, terms, keep), "postings")


def contaminated_windows(
    docs: DataFrame, items: DataFrame, anchors: DataFrame, index: DataFrame, keep=stored
) -> DataFrame:
    """``key``, ``item_id`` and the ``places`` of its windows that occur, and their ``size``."""
    both = _alignments(index, anchors, "one").join(
        _alignments(index, anchors, "two").drop("size"), ["key", "item", "start", "shift"], "left_semi"
    )
    place = F.col("shift") + F.col("start")
    aligned = both.where(place >= 0).groupBy(
        "key", "item", "shift", "size", F.floor(place / BLOCK).cast("int").alias("block")
    ).agg(F.collect_set("start").alias("starts"))
    aligned = keep(aligned, "alignments")
    texts = docs.select(
        F.struct("doc_id", F.xxhash64("text").alias("version")).alias("key"), "text"
    )
    # Only documents with an alignment are read again; their keys, of some 64 bytes
    # each, are broadcast if they fit, else joined by shuffle.
    wanted = keep(aligned.select("key").distinct(), "keys")
    if wanted.count() * 64 <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    texts = texts.join(wanted, "key", "left_semi").dropDuplicates(["key"])
    checked = aligned.join(items.drop("size"), "item").join(_blocks(texts), ["key", "block"])
    exact = F.expr(
        f"""filter(starts, s -> slice(block_words, s + shift - block * {BLOCK} + 1, size)
                              = slice(item_words, s + 1, size))"""
    )
    places = F.transform(exact, lambda s: s + F.col("shift"))
    return checked.select("key", "item_id", "size", places.alias("places")).where(F.size("places") > 0)


def proximity(anchors: DataFrame, index: DataFrame, within: int = WINDOW) -> DataFrame:
    """``key`` and ``item`` where a document holds both terms of a window near each other.

    Terms meet by document and stretch of ``within`` words, so a term that a text repeats
    all over is compared with its neighbours alone.
    """
    lone = F.col("size") == 1
    rules = anchors.select("item", "one.term", F.col("two.term").alias("other"), lone.alias("lone")).distinct()
    stretch = F.floor(F.col("pos") / within)
    first = index.join(rules, "term")
    alone = first.where("lone").select("key", "item")
    pairs = first.where("NOT lone").select(
        "key", "item", "other", "pos", F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch")
    )
    second = index.select("key", F.col("term").alias("other"), F.col("pos").alias("pos2"), stretch.alias("stretch"))
    apart = F.abs(F.col("pos2") - F.col("pos"))
    near = pairs.join(second, ["key", "other", "stretch"]).where((apart > 0) & (apart <= within))
    return near.select("key", "item").unionByName(alone).distinct()


def _hits(found: DataFrame) -> DataFrame:
    """Per document the number of words that are hit and its items."""
    ranges = F.flatten(
        F.transform("places", lambda p: F.sequence(p, p + F.col("size") - 1))
    )
    return found.groupBy("key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.array_distinct(ranges))))).alias("hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``version`` and the hits of every row of ``docs``."""
    with Temporary() as temp:
        items, anchors, index = _index(docs, benchmark, temp)
        hits = temp(_hits(contaminated_windows(docs, items, anchors, index, temp)), "exact")
        near = proximity(anchors, index).groupBy("key").agg(F.count(F.lit(1)).alias("n_near"))
        hits = stored(hits.join(near, "key", "full"), "hits")
    all_ = _documents(docs).select("key", F.size("doc_words").cast("long").alias("n_words"))
    joined = all_.join(hits, "key", "left")
    n_hit = F.coalesce(F.col("hit"), F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select(
        "key.doc_id",
        "key.version",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near_items"),
    )


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).drop("version")


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}',
         '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}',
         '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS size,
         array_to_string(list_slice(w, p + 1, p + least(len(w), {WINDOW})), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(0, len(w) - least(len(w), {WINDOW}) + 1)) AS p
        FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, size, p, array_to_string(list_slice(w, p + 1, p + size), ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS p
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, p, dw.size AS size, item_id FROM dw JOIN bw ON dw.phrase = bw.phrase AND dw.size = bw.size
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
), dt AS (
  SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS p FROM d
), tc AS (
  SELECT term, count(*) AS n FROM dt GROUP BY term
), bt AS (
  SELECT item_id, w, size, p, unnest(list_slice(w, p + 1, p + size)) AS term, unnest(range(size)) AS k
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS size,
               unnest(range(0, len(w) - least(len(w), {WINDOW}) + 1)) AS p
        FROM (SELECT DISTINCT * FROM b) WHERE len(w) > 0)
), rare AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, w, p ORDER BY n, term, k) AS r,
         count(*) OVER (PARTITION BY item_id, w, p) AS found
  FROM bt JOIN tc USING (term)
), rules AS (
  SELECT DISTINCT item_id, w, one, other, size = 1 AS lone
  FROM (SELECT item_id, w, p, any_value(size) AS size, min_by(term, r) AS one, max_by(term, r) AS other
        FROM rare WHERE found = size AND r <= 2 GROUP BY item_id, w, p)
), near AS (
  SELECT DISTINCT x.doc_id, item_id, w
  FROM rules JOIN dt x ON x.term = one
  JOIN dt y ON y.doc_id = x.doc_id AND y.term = other
  WHERE lone OR abs(x.p - y.p) BETWEEN 1 AND {WINDOW}
), nears AS (
  SELECT doc_id, count(*) AS n_near FROM near GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated,
       coalesce(n_near, 0) AS n_near_items
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN ids USING (doc_id) LEFT JOIN nears USING (doc_id)
"""
