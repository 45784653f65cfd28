"""Reference data: the merchant catalog and the pay rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.operators.contract import enforce_contract
from passbook.schemas import CONTRACTS
from passbook.sources.defaults import MERCHANT_CATALOG, PLACEHOLDER_PAYRATE
from passbook.sources.inline import literal_table


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column as text.

    Quotes are escaped by doubling, so backslashes in patterns stay as written.
    """
    return spark.read.option("header", True).option("escape", '"').csv(path)


def typed(df: DataFrame, table: str) -> DataFrame:
    """Strict casts of the contract's columns, picked by name."""
    contract = CONTRACTS[table]
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in contract]
    return enforce_contract(df.select(*columns), table)


def merchant_catalog(
    spark: SparkSession, replacement: str | None = None, overlay: str | None = None
) -> DataFrame:
    """The regex catalog.

    ``replacement`` takes the place of the built-in catalog and switches the
    overlay off; otherwise the rows of ``overlay`` are added.
    """
    table = "map_merchant_category_regex"
    if replacement:
        return typed(read_csv(spark, replacement), table)
    catalog = literal_table(spark, MERCHANT_CATALOG, CONTRACTS[table])
    if overlay:
        catalog = catalog.unionByName(typed(read_csv(spark, overlay), table))
    return catalog


def pay_rates(spark: SparkSession, replacement: str | None = None) -> DataFrame:
    """Pay-rate periods; the built-in row pays nothing."""
    table = "stg_payrate"
    if replacement:
        return typed(read_csv(spark, replacement), table)
    return literal_table(spark, [PLACEHOLDER_PAYRATE], CONTRACTS[table])
