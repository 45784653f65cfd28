"""Nested account snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.schemas import SNAPSHOT
from passbook.sources.folders import folder_exists
from passbook.sources.paths import data_path

# Layout of the raw files, YYYY/MM/DD/<time>Z_bd<epoch>.json.
SNAPSHOT_GLOB = "transactions/*/*/*/*.json"
BALANCE_DATE_IN_NAME = r"_bd(\d+)\.json$"


def _with_lineage(df: DataFrame) -> DataFrame:
    return df.select("errors", "accounts", F.col("_metadata.file_path").alias("filename"))


def read_snapshots(
    spark: SparkSession,
    root: str,
    glob: str = SNAPSHOT_GLOB,
    one_document_per_file: bool = True,
) -> DataFrame:
    """All snapshots under the root, with the file each came from.

    The explicit schema avoids an inference pass and keeps columns stable when a
    file lacks a field.  A malformed document fails the read.
    """
    return _with_lineage(
        spark.read.schema(SNAPSHOT)
        .option("multiLine", one_document_per_file)
        .option("mode", "FAILFAST")
        .json(data_path(root, glob))
    )


def read_arrivals(spark: SparkSession, root: str, glob: str = SNAPSHOT_GLOB) -> DataFrame:
    """One row per file for the admission rule, also for files that do not parse.

    A file that is empty or holds no such document has NULL accounts, which the
    rule counts as empty.  The tables are never built from this reader.
    """
    files = spark.read.text(data_path(root, glob), wholetext=True)
    document = F.from_json("value", SNAPSHOT, {"mode": "PERMISSIVE"})
    return files.select(
        document["errors"].alias("errors"),
        document["accounts"].alias("accounts"),
        F.col("_metadata.file_path").alias("filename"),
    )


def list_files(
    spark: SparkSession, root: str, glob: str = SNAPSHOT_GLOB, days: list[dt.date] | None = None
) -> DataFrame:
    """``filename``, ``modified_at`` and ``length`` of stored files, without their content.

    ``days`` keeps the listing to the folders of these dates, where there are any.
    """
    head, _, last = data_path(root, glob).rpartition("/")
    paths = [data_path(root, glob)]
    if days is not None:
        folder = head.removesuffix("/*/*/*")
        every = [f"{folder}/{day:%Y/%m/%d}" for day in days]
        paths = [f"{path}/{last}" for path in every if folder_exists(spark, path)]
    if not paths:
        return spark.createDataFrame([], "filename string, modified_at timestamp, length long")
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col("path").alias("filename"), F.col("modificationTime").alias("modified_at"), "length")


def stream_snapshots(
    spark: SparkSession,
    root: str,
    glob: str = SNAPSHOT_GLOB,
    one_document_per_file: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same files as a stream; new files are picked up as they land."""
    reader = (
        spark.readStream.schema(SNAPSHOT)
        .option("multiLine", one_document_per_file)
        .option("mode", "FAILFAST")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_lineage(reader.json(data_path(root, glob)))


def stream_documents(
    spark: SparkSession,
    root: str,
    glob: str = SNAPSHOT_GLOB,
    one_document_per_file: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The files as a stream that no bad document ends.

    Every file, or every line, is one row.  ``reason`` is NULL for a readable document;
    else it tells why none could be read: ``empty``, ``not json`` (cut short, too) or
    ``no accounts``, as in a document of another kind or one that reports only errors.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    broken = "_unread"
    wanted = T.StructType([*SNAPSHOT.fields, T.StructField(broken, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    text = reader.text(data_path(root, glob), wholetext=one_document_per_file)
    document = text.select(
        F.from_json("value", wanted, options).alias("d"),
        ~F.col("value").rlike(r"\S"),
        F.col("_metadata.file_path").alias("filename"),
    ).toDF("d", "blank", "filename")
    reason = (
        F.when(F.col("blank"), "empty")
        .when(F.col("d").isNull() | F.col(f"d.{broken}").isNotNull(), "not json")
        .when(F.col("d.accounts").isNull(), "no accounts")
    )
    return document.select("d.errors", "d.accounts", "filename", reason.alias("reason"))


def flatten_accounts(snapshots: DataFrame) -> DataFrame:
    """One row per account per snapshot."""
    account = snapshots.select(F.explode("accounts").alias("a"), "filename")
    return account.select(
        F.col("a.id").alias("bank_account_id"),
        F.col("a.name").alias("bank_account_name"),
        F.col("a.currency").alias("currency"),
        F.col("a.balance").try_cast("decimal(14,2)").alias("actual_balance"),
        F.col("a.`available-balance`")
        .try_cast("decimal(14,2)")
        .alias("available_balance"),
        F.timestamp_seconds("a.`balance-date`").alias("balance_as_of_timestamp"),
        "filename",
    )


def flatten_transactions(snapshots: DataFrame) -> DataFrame:
    """One row per transaction per snapshot; accounts without any vanish.

    The amount cast is strict: a bad amount fails the build.
    """
    account = snapshots.select(F.explode("accounts").alias("a"), "filename")
    txn = account.select(
        F.col("a.id").alias("bank_account_id"),
        F.col("a.name").alias("bank_account_name"),
        F.explode("a.transactions").alias("t"),
        "filename",
    )
    return txn.select(
        "bank_account_id",
        "bank_account_name",
        F.col("t.id").alias("txn_id"),
        F.col("t.description").alias("txn_description"),
        F.col("t.payee").alias("payee"),
        F.col("t.amount").cast("decimal(14,2)").alias("amount"),
        F.timestamp_seconds("t.posted").alias("posted_at_timestamp"),
        "filename",
    )
