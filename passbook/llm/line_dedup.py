"""Boilerplate lines by their frequency within a site.

A line is boilerplate on its host when the share of the host's pages that hold it is
above ``ratio`` and at least ``least_pages`` pages hold it.  Lines are compared after
trimming white space; blank lines are never boilerplate.  Everything is DataFrame
functions.

Each page counts a line once, and pages of a host are counted on the map side first,
so a host or line that holds a third of all rows reaches the shuffle as one row per
task.  Lines travel as 128-bit digests.  The lines of a host above the ratio are few
(at most lines per page / ratio on average); pages get theirs by a join on host and
digest that Spark splits where a host is hot.

Cases: a NULL or empty text has no line to lose and stays as it is; a NULL host is a
host of its own; rows repeated in full count as one page each; rows of one id with
other texts are judged each for itself; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.llm.tables import stored

RATIO = 0.01
LEAST_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _digest(line: Column) -> Column:
    """128 bits of a trimmed line; NULL for a blank one."""
    bare = F.trim(F.regexp_replace(line, r"[\t\x0B\f\r]", " "))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def _keyed(pages: DataFrame, page_id: str, host: str, text: str) -> DataFrame:
    version = F.xxhash64(F.col(host), F.col(text)).alias("version")
    return pages.select(
        F.struct(F.col(page_id).alias("id"), version).alias("page"),
        F.coalesce(F.concat(F.lit("h"), F.col(host)), F.lit("")).alias("host"),
        F.col(text).alias("text"),
    )


def boilerplate(
    pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``host``, ``digest``, ``n_with`` and ``n_pages`` of each boilerplate line."""
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    each = pages.select(
        "host", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _digest))).alias("digest")
    ).where("digest IS NOT NULL")
    counts = each.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n_with"))
    often = counts.where(F.col("n_with") >= least_pages).join(hosts, "host")
    return often.where(F.col("n_with") > ratio * F.col("n_pages"))


def without_boilerplate(
    pages: DataFrame,
    page_id: str = "doc_id",
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``page_id``, line counts, ``kept_text`` and its digest of every row of ``pages``."""
    keyed = _keyed(pages, page_id, host, text)
    common = stored(boilerplate(keyed, ratio, least_pages).select("host", "digest"), "boilerplate")
    each = keyed.select(
        "page",
        "host",
        F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _digest))).alias("digest"),
    ).where("digest IS NOT NULL")
    drops = each.join(common, ["host", "digest"], "left_semi")
    drops = drops.groupBy("page").agg(F.collect_set("digest").alias("drop"))
    lines = _lines(F.col("text"))
    kept = F.when(F.col("drop").isNull(), lines).otherwise(
        F.filter(lines, lambda line: ~F.coalesce(F.array_contains(F.col("drop"), _digest(line)), F.lit(False)))
    )
    joined = keyed.select("page", "text").join(drops, "page", "left").withColumn("kept", kept)
    kept_text = F.when(F.col("text").isNotNull(), F.array_join("kept", "\n"))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    n_kept = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("kept")).cast("long")
    return joined.select(
        F.col("page.id").alias(page_id),
        n_lines.alias("n_lines"),
        (n_lines - n_kept).alias("n_dropped"),
        kept_text.alias("kept_text"),
        F.sha2(F.coalesce(kept_text, F.lit("")), 256).alias("kept_sha256"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return without_boilerplate(docs).drop("kept_text")


OP1_SQL = rf"""
WITH lines AS (
  SELECT doc_id, source, p, line,
         trim(regexp_replace(line, '[\t\x0B\f\r]', ' ', 'g'), ' ') AS bare
  FROM (SELECT doc_id, source, unnest(range(1, len(l) + 1)) AS p, unnest(l) AS line
        FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), hosts AS (
  SELECT source, count(*) AS n_pages FROM documents GROUP BY source
), common AS (
  SELECT source, bare
  FROM (SELECT source, bare, count(DISTINCT doc_id) AS n_with FROM lines WHERE bare <> '' GROUP BY source, bare)
  JOIN hosts USING (source)
  WHERE n_with >= {LEAST_PAGES} AND n_with > {RATIO} * n_pages
), marked AS (
  SELECT lines.*, common.bare IS NOT NULL AS dropped
  FROM lines LEFT JOIN common ON lines.source = common.source AND lines.bare = common.bare
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
