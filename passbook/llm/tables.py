"""Tables in the shared folder, which cut lineage for good."""

from __future__ import annotations

from pyspark.sql import DataFrame

from passbook.session import scratch_path
from passbook.sources.folders import remove_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table under the shared folder and read back."""
    return _write(df, name)[0]


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


class Temporary:
    """Stored tables that go when the block ends.

    What outlives the block must be ``stored`` inside it, so that nothing reads the
    removed tables later, also not to recompute what a lost executor held.
    """

    def __init__(self) -> None:
        self._paths: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Temporary:
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        kept, path = _write(df, name)
        self._paths.append((kept, path))
        return kept

    def __exit__(self, *_: object) -> None:
        for df, path in self._paths:
            remove_folder(df.sparkSession, path)
