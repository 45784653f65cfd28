"""Exact duplicates by distributed MSD radix partitioning.

Texts are compared after deleting white space.  Level by level, documents are
split by their next bytes; a group that becomes a singleton is done, and so is
one whose texts have ended, as its members agree in every byte.  Equality never
rests on a digest.  Digits get four times wider per level, so a text of n bytes
needs about log4(n / 32) levels.

A level ships one counted row per group and map task (partial aggregation), so a
group that holds a third of all rows stays small; marking its members is an
inner join, whose large partitions Spark splits at run time.

Cases: a NULL text counts as empty; empty texts are equal to each other; rows
repeated in full are members of one group of which one row is kept; a NULL
doc_id sorts first; an empty table gives an empty result; other columns, also
ones named like the results, stay inside ``document``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.llm.tables import Temporary, stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"
FIRST_DIGIT = 32
WIDER = 4


def squeezed(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _shared(digits: DataFrame, keys: list[str], temp: Temporary) -> DataFrame:
    """Members of the groups of at least two rows, with the new group's number."""
    groups = digits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("next"))
    # Stored, so that both sides of the join are exchanged and a hot group can be split.
    return digits.join(temp(groups.where("n > 1").drop("n"), "groups"), keys)


def _members(rows: DataFrame, temp: Temporary) -> DataFrame:
    """``row`` and ``group`` of every row that equals another one."""
    heads = rows.select("row", F.col("head").alias("digit"))
    parted = _shared(heads, ["digit"], temp)
    width, done = FIRST_DIGIT, []
    ended = F.length("digit") < width
    first = parted.select("row", F.col("next").alias("group"), ended.alias("ended"))
    texts = rows.select("row", squeezed(F.col("document.text")).cast("binary").alias("rest"))
    rest = F.when(~F.col("ended"), F.expr(f"substring(rest, {width + 1})"))
    level = temp(
        first.join(texts, "row").select("row", "group", "ended", rest.alias("rest")), "radix"
    )
    while True:
        done.append(level.where("ended").select("row", "group"))
        active = level.where(~F.col("ended"))
        if active.isEmpty():
            return reduce(DataFrame.unionByName, done)
        width *= WIDER
        digits = active.select("row", "group", F.expr(f"substring(rest, 1, {width})").alias("digit"))
        parted = _shared(digits, ["group", "digit"], temp).select(
            "row",
            F.col("next").alias("group"),
            (F.length("digit") < width).alias("ended"),
        )
        kept = active.select("row", F.expr(f"substring(rest, {width + 1})").alias("rest"))
        rest = F.when(~F.col("ended"), F.col("rest"))
        level = temp(
            parted.join(kept, "row").select("row", "group", "ended", rest.alias("rest")), "radix"
        )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` with its group of equal texts.

    ``docs`` needs ``doc_id`` and ``text``.  Of equal texts the row with the most
    code points stays, then the smallest ``doc_id``.  Columns: ``document`` (the
    row as it was), ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` of the squeezed text.
    """
    document = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document")
    whole = docs.select(document).withColumn("norm", squeezed(F.col("document.text")))
    rows = stored(
        whole.select(
            F.monotonically_increasing_id().alias("row"),
            "document",
            F.expr(f"substring(cast(norm AS binary), 1, {FIRST_DIGIT})").alias("head"),
            F.coalesce(F.length("document.text"), F.lit(0)).alias("points"),
            F.sha2("norm", 256).alias("text_sha256"),
        ),
        "exact-rows",
    )
    with Temporary() as temp:
        members = stored(_members(rows, temp), "members")
    grouped = rows.select("row", F.col("document.doc_id").alias("doc_id"), "points").join(
        members, "row"
    )
    best = grouped.groupBy("group").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("points")).alias("p"), "doc_id", "row")).alias("best"),
    )
    decided = grouped.join(stored(best, "best"), "group").select(
        "row",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )
    alone = F.col("group_size").isNull()
    doc_id = F.col("document.doc_id")
    return rows.join(decided, "row", "left").select(
        "document",
        doc_id.alias("doc_id"),
        F.when(alone, doc_id).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        "text_sha256",
    )


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_duplicates(docs).drop("document")


OP10_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS whole,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), ranked AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(whole) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM ranked
"""
