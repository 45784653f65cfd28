"""Places of rows per key when one key may hold much of all rows.

A window over a key sorts the whole key in one task.  Here the rows are range-sorted by key
and order, so a hot key spreads over files; a row's place is its place in its file plus the
rows that its key has in earlier files, which are one count per file and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.session import scratch_path

# monotonically_increasing_id keeps the place in the partition in its lower bits.
FILE_BITS = 33


def range_sorted(rows: DataFrame, keys: list[str], order: list[Column], path: str) -> DataFrame:
    """``rows`` stored under ``path`` in the order of ``keys`` and ``order``.

    ``_at`` rises along the whole table and ``_file`` numbers its parts.  Rows equal in
    keys and order are parted by where they came from, so they spread, too.  Stored, since
    a range exchange chooses other bounds each time it runs.
    """
    by = [*[F.col(key).asc_nulls_first() for key in keys], *order, F.col("_row").asc()]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    sorted_ = numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
    sorted_ = sorted_.withColumn("_at", F.monotonically_increasing_id())
    sorted_.write.parquet(path)
    stored = rows.sparkSession.read.schema(sorted_.schema).parquet(path)
    return stored.withColumn("_file", F.shiftright("_at", FILE_BITS))


def placed(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place ``name`` from 1 on within ``keys``; NULL keys are a key.

    The rows are stored once in the shared folder, in the order of the places.
    """
    spark = rows.sparkSession
    table = range_sorted(rows, keys, order, scratch_path(spark, f"by-{name}"))
    table = table.withColumn("_key", F.struct(*keys))
    parts = table.groupBy("_key", "_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("_key").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_key", "_file", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return (
        table.join(starts, ["_key", "_file"])
        .withColumn(name, place)
        .drop("_key", "_file", "_at", "_first", "_before")
    )


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """The rows of a sorted DataFrame with their place ``name`` from 1 on.

    A sorted DataFrame lies in its partitions in order; it is stored as it lies, and a row's
    place is its place in its file plus the rows of the files before.
    """
    spark = ordered.sparkSession
    path = scratch_path(spark, f"ordered-{name}")
    at = ordered.withColumn("_at", F.monotonically_increasing_id())
    at.write.parquet(path)
    table = spark.read.schema(at.schema).parquet(path).withColumn("_file", F.shiftright("_at", FILE_BITS))
    files = table.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # One row per file of the sort.
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return table.join(F.broadcast(starts), "_file").withColumn(name, place).drop(
        "_file", "_at", "_first", "_before"
    )
