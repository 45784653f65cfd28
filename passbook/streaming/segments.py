"""Stores made of segments, each a folder that is written once.

Every batch is a segment of level 0, named by stream and batch, so a retried batch
overwrites itself and streams with other checkpoints cannot meet.  ``compact`` merges
``FAN_IN`` segments of a level into one of the next, so a row is rewritten once per level
and not once per batch.  A merged segment counts from the moment its write has ended; the
names it covers are written before, so a merge that broke off is never read and a covered
segment is never read twice.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.sources.folders import complete_folders, remove_folder

# Segments of one level that are merged into one of the next.
FAN_IN = 4
BUCKETS = 16


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Segments:
    """Names and levels; subclasses say how a segment is laid out."""

    path: str

    def absorb(self, batch: DataFrame, batch_id: int, stream: str = "direct") -> None:
        """Store one batch; a ``foreachBatch`` sink that may be retried."""
        spark, name = batch.sparkSession, f"level0-{stream}-{batch_id}"
        names = self._names(spark)
        if name not in self._covered(spark, names):
            self._write_batch(batch, name)

    def compact(self, spark: SparkSession, fan_in: int = FAN_IN) -> None:
        """Merge levels that have ``fan_in`` segments and remove what they cover."""
        while full := self._full_level(spark, fan_in):
            level, names = full
            merged = f"level{level + 1}-{uuid.uuid4().hex}"
            covered = spark.createDataFrame([(name,) for name in names], "name string")
            covered.coalesce(1).write.parquet(f"{self.path}/covers/{merged}")
            self._write_merged(spark, names, merged)
            for name in names:
                remove_folder(spark, self._folder(name))

    def _write_batch(self, batch: DataFrame, name: str) -> None:
        raise NotImplementedError

    def _write_merged(self, spark: SparkSession, names: list[str], merged: str) -> None:
        raise NotImplementedError

    def _folder(self, name: str) -> str:
        return f"{self.path}/segments/{name}"

    @staticmethod
    def _level(name: str) -> int:
        return int(name.split("-")[0].removeprefix("level"))

    def _full_level(self, spark: SparkSession, fan_in: int) -> tuple[int, list[str]] | None:
        levels: dict[int, list[str]] = {}
        for name in self._live(spark):
            levels.setdefault(self._level(name), []).append(name)
        return next(((k, names) for k, names in sorted(levels.items()) if len(names) >= fan_in), None)

    def _names(self, spark: SparkSession) -> list[str]:
        return complete_folders(spark, f"{self.path}/segments")

    def _covered(self, spark: SparkSession, names: list[str]) -> set[str]:
        """Names that complete merged segments stand for, a few per batch absorbed."""
        lists = set(complete_folders(spark, f"{self.path}/covers")) & set(names)
        if not lists:
            return set()
        rows = spark.read.parquet(*[f"{self.path}/covers/{name}" for name in sorted(lists)])
        return {row.name for row in rows.collect()}

    def _live(self, spark: SparkSession) -> list[str]:
        names = self._names(spark)
        covered = self._covered(spark, names)
        return [name for name in names if name not in covered]


@dataclass(frozen=True)
class LatestStore(Segments):
    """A table that keeps the newest row per key across micro-batches.

    Every segment is one row per key, in ``buckets`` files by hash of the key and sorted by
    it.  All segments together are read as one bucketed table, partitioned by segment, so
    the rows of a key are in one task as they are read: ``current`` and ``compact`` need no
    exchange, whatever the size of the store.
    """

    pick: Callable[[DataFrame], DataFrame]
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    def current(self, spark: SparkSession) -> DataFrame:
        """One row per key: the newest of everything absorbed so far."""
        live = self._live(spark)
        if not live:
            return spark.createDataFrame([], self.schema)
        rows = self._read(spark, live)
        return rows if len(live) == 1 else self.pick(rows)

    def _write_batch(self, batch: DataFrame, name: str) -> None:
        self._write(self.pick(batch).repartition(self.buckets, *self.keys), name)

    def _write_merged(self, spark: SparkSession, names: list[str], merged: str) -> None:
        self._write(self.pick(self._read(spark, names)), merged)

    def _write(self, rows: DataFrame, name: str) -> None:
        spark, table = rows.sparkSession, f"passbook_write_{uuid.uuid4().hex}"
        remove_folder(spark, self._folder(name))
        rows = rows.select(*self.schema.names).sortWithinPartitions(*self.keys)
        writer = rows.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.option("path", self._folder(name)).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # external: the files stay

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame:
        """The named segments as partitions of one bucketed table.

        The table is a view on the files for this session; its name tells its content, so
        an earlier result stays readable as long as its segments exist.
        """
        content = "\n".join([self.path, str(self.buckets), *sorted(names)])
        table = f"passbook_read_{hashlib.md5(content.encode()).hexdigest()}"
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys = ", ".join(f"`{key}`" for key in self.keys)
            spark.sql(
                f"CREATE TABLE {table} ({columns}, segment STRING) USING parquet PARTITIONED BY (segment)"
                f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS"
                f" LOCATION {_quoted(f'{self.path}/segments')}"
            )
            parts = [f"PARTITION (segment={_quoted(n)}) LOCATION {_quoted(self._folder(n))}" for n in names]
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts)}")
        return spark.table(table).select(*self.schema.names)


@dataclass(frozen=True)
class FirstSeenStore(Segments):
    """Rows whose id was not stored before, of any age.

    A segment of level n is ``FAN_IN ** n`` folders by hash of the id, so a folder keeps its
    size while the store grows.  A batch is reduced to one row per id and reads, of each
    segment, the ids in the folders that it touches: at most one for each of its ids.  What
    a small batch reads grows with the number of levels, the logarithm of the store.
    """

    schema: T.StructType
    key: str
    pick: Callable[[DataFrame], DataFrame]
    stage: Callable[[SparkSession, str], str]

    def rows(self, spark: SparkSession) -> DataFrame:
        """Everything first seen so far."""
        live = self._live(spark)
        if not live:
            return spark.createDataFrame([], self.schema)
        return self._read(spark, live).select(*self.schema.names)

    def known(self, spark: SparkSession, names: list[str], touched: set[int]) -> DataFrame:
        """The stored rows in the folders of ``touched``, hashes modulo the most folders of ``names``."""
        found = self._read(spark, names)
        near = None
        for level in sorted({self._level(name) for name in names}):
            parts = self._parts(level)
            wanted = sorted({bucket % parts for bucket in touched})  # parts divides finest
            here = F.col("segment").startswith(f"level{level}-") & F.col("bucket").isin(wanted)
            near = here if near is None else near | here
        return found.where(near)

    @staticmethod
    def _parts(level: int) -> int:
        return FAN_IN**level

    def _bucket(self, parts: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(parts)).cast("int")

    def _write_batch(self, batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        others = [other for other in self._live(spark) if other != name]
        fresh = self.pick(batch)
        if others:
            # Stored once: its ids choose the folders, then its rows are compared.
            staged = self.stage(spark, "first-seen-batch")
            fresh.write.parquet(staged)
            fresh = spark.read.schema(fresh.schema).parquet(staged)
            finest = max(self._parts(self._level(other)) for other in others)
            # At most as many numbers as the store has folders.
            touched = {row.b for row in fresh.select(self._bucket(finest).alias("b")).distinct().collect()}
            known = self.known(spark, others, touched).select(self.key)
            fresh = fresh.join(known, self.key, "left_anti")
            self._write(fresh, name, 1)
            remove_folder(spark, staged)
        else:
            self._write(fresh, name, 1)

    def _write_merged(self, spark: SparkSession, names: list[str], merged: str) -> None:
        self._write(self._read(spark, names), merged, self._parts(self._level(merged)))

    def _write(self, rows: DataFrame, name: str, parts: int) -> None:
        rows = rows.select(*self.schema.names, self._bucket(parts).alias("bucket"))
        if parts > 1:
            rows = rows.repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(name))

    def _folder(self, name: str) -> str:
        return f"{self.path}/segments/segment={name}"

    def _names(self, spark: SparkSession) -> list[str]:
        return [name.removeprefix("segment=") for name in super()._names(spark)]

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame:
        parts = [T.StructField("segment", T.StringType()), T.StructField("bucket", T.IntegerType())]
        reader = spark.read.schema(T.StructType([*self.schema.fields, *parts]))
        folders = [self._folder(name) for name in names]
        return reader.option("basePath", f"{self.path}/segments").parquet(*folders)

