"""Parquet tables: the scan and the published write.

A table's files are written once, in the folder of their release, and never touched again.
Which release a table is read from is told by the newest manifest under the root, a small
numbered file that appears whole or not at all.  So readers see all tables of a release at
once, a write that breaks off leaves them on the release before, and two writers cannot
mix their tables.  The release before the newest stays for readers that are under way.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from passbook.operators.contract import enforce_contract
from passbook.operators.quality import watched
from passbook.schemas import CONTRACTS
from passbook.sources.folders import create_text, file_names, read_text, remove_folder, sub_folders
from passbook.sources.paths import data_path, table_path

MANIFESTS = "_manifests"
RELEASES = "_releases"
KEPT = 2

# Parquet keeps a column as numbers of a dictionary up to this size.  By its default of 1 MB
# tens of thousands of merchant keys of 32 characters would be written out in every row.
DICTIONARY_BYTES = 4 << 20


def _manifest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number of the newest manifest, 0 if none, and the release of each of its tables."""
    numbers = [int(n.removesuffix(".json")) for n in file_names(spark, data_path(root, MANIFESTS), ".json")]
    if not numbers:
        return 0, {}
    return max(numbers), _tables_of(spark, root, max(numbers))


def _tables_of(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    return json.loads(read_text(spark, _manifest_path(root, number)))


def _manifest_path(root: str, number: int) -> str:
    return data_path(root, f"{MANIFESTS}/{number:012d}.json")


def _release_path(root: str, release: str, table: str) -> str:
    return table_path(data_path(root, f"{RELEASES}/{release}"), table)


def current_path(spark: SparkSession, root: str, table: str) -> str:
    """Where the published table lies; its plain place if none was published."""
    release = _manifest(spark, root)[1].get(table)
    return table_path(root, table) if release is None else _release_path(root, release, table)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Scan a modelled table under its contract; no schema inference pass."""
    return spark.read.schema(CONTRACTS[table]).parquet(current_path(spark, root, table))


class Release:
    """Tables that are written one by one and published together.

    As a context manager it removes what was written when the block ends without
    ``publish``, by an error or on purpose.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.name = spark, root, uuid.uuid4().hex
        self._tables: list[str] = []
        self._seen: dict[str, Observation] = {}
        self._published = False

    def __enter__(self) -> Release:
        return self

    def __exit__(self, *_: object) -> None:
        if not self._published:
            remove_folder(self.spark, data_path(self.root, f"{RELEASES}/{self.name}"))

    def write(
        self,
        df: DataFrame,
        table: str,
        clustered_by: list[str] | None = None,
        watch_nulls: list[str] | None = None,
        derived: dict[str, Column] | None = None,
    ) -> DataFrame:
        """Store a table in this release and read it back from there.

        ``clustered_by`` sorts the rows of each file as the tasks hold them, without an
        exchange: every file is a sorted run, of which a later filter on the first column
        can skip row groups and pages.  Timestamps have the statistics for that only where
        ``spark.sql.parquet.outputTimestampType`` is ``TIMESTAMP_MICROS``; Spark's default
        has none.  Rows lie in the files of the tasks that hold them.
        ``derived`` columns follow from others by these expressions; they are left out of
        the sort and taken anew after it.
        ``watch_nulls`` counts rows and NULLs of these columns on the way; see ``counts``.
        """
        checked, path = enforce_contract(df, table), _release_path(self.root, self.name, table)
        if watch_nulls is not None:
            checked, self._seen[table] = watched(checked, watch_nulls)
        if clustered_by:
            order = [F.col(name).asc_nulls_last() for name in clustered_by]
            rows = checked.drop(*(derived or {})).sortWithinPartitions(*order)
            checked = rows.withColumns(derived or {}).select(*CONTRACTS[table].names)
        checked.write.option("parquet.dictionary.page.size", DICTIONARY_BYTES).parquet(path)
        self._tables.append(table)
        return self.spark.read.schema(CONTRACTS[table]).parquet(path)

    @property
    def counts(self) -> dict[str, dict[str, int]]:
        """Rows (``ROWS``) and NULLs by column of the tables that were watched."""
        return {table: seen.get for table, seen in self._seen.items()}

    def publish(self) -> None:
        """Let readers see all tables of this release, and remove releases out of use."""
        while True:
            number, tables = _manifest(self.spark, self.root)
            merged = json.dumps(tables | dict.fromkeys(self._tables, self.name), indent=1, sort_keys=True)
            if create_text(self.spark, _manifest_path(self.root, number + 1), merged):
                break  # else another writer took the number: add to what it published
        self._published = True
        self._remove_old(number + 1)

    def _remove_old(self, newest: int) -> None:
        numbers = [n for n in range(newest - KEPT + 1, newest + 1) if n > 0]
        used = {release for n in numbers for release in _tables_of(self.spark, self.root, n).values()}
        before = {release for release in self._named_before(newest - KEPT) if release not in used}
        for release in before:
            remove_folder(self.spark, data_path(self.root, f"{RELEASES}/{release}"))

    def _named_before(self, last: int) -> set[str]:
        """Releases of the manifests up to ``last``, whose files go with them."""
        found: set[str] = set()
        for name in file_names(self.spark, data_path(self.root, MANIFESTS), ".json"):
            number = int(name.removesuffix(".json"))
            if number <= last:
                found |= set(_tables_of(self.spark, self.root, number).values())
                remove_folder(self.spark, _manifest_path(self.root, number))
        return found


def write_table(
    df: DataFrame, root: str, table: str, clustered_by: list[str] | None = None
) -> str:
    """Replace one modelled table: a release of its own."""
    spark = df.sparkSession
    with Release(spark, root) as release:
        release.write(df, table, clustered_by)
        release.publish()
    return current_path(spark, root, table)


def unpublished(spark: SparkSession, root: str) -> list[str]:
    """Releases no manifest names, left by writers that were killed; safe to remove then."""
    named = {
        release
        for name in file_names(spark, data_path(root, MANIFESTS), ".json")
        for release in _tables_of(spark, root, int(name.removesuffix(".json"))).values()
    }
    return sorted(set(sub_folders(spark, data_path(root, RELEASES))) - named)
