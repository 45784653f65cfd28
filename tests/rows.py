"""Small hand-written inputs."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from passbook.plans import star
from passbook.schemas import CONTRACTS, FLAT_TRANSACTION


def at(text: str) -> dt.datetime:
    """A UTC instant, whatever zone the test process runs in."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def epoch(text: str) -> int:
    return int(at(text).timestamp())


def flat_row(
    txn_id: str | None,
    posted: str,
    amount: str,
    description: str | None = "corner shop",
    payee: str | None = "Shop",
    account: str = "Checking",
    account_id: str = "a1",
    filename: str = "f1",
) -> tuple:
    return (
        account_id,
        account,
        txn_id,
        description,
        payee,
        Decimal(amount),
        at(posted),
        filename,
    )


def flat(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FLAT_TRANSACTION)


def fact(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return star.fact_from_flat(flat(spark, rows), "2026-08-01 00:00:00")


def catalog(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CONTRACTS["map_merchant_category_regex"])


def rates(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    typed = [
        (name, "", Decimal(pay), dt.date.fromisoformat(a), dt.date.fromisoformat(b))
        for name, pay, a, b in rows
    ]
    return spark.createDataFrame(typed, CONTRACTS["stg_payrate"])


def txn(txn_id: str, posted: str, amount: str, description: str | None, payee: str | None) -> dict:
    return {
        "id": txn_id,
        "posted": epoch(posted),
        "amount": amount,
        "description": description,
        "payee": payee,
        "memo": "",
        "transacted_at": epoch(posted),
        "mcc": None,
    }


def account(name: str, balance: str, as_of: str, txns: list[dict], key: str = "id-1") -> dict:
    return {
        "id": key,
        "name": name,
        "currency": "USD",
        "balance": balance,
        "available-balance": balance,
        "balance-date": epoch(as_of),
        "transactions": txns,
        "holdings": [],
        "org": {"domain": "bank.example", "name": "Bank", "sfin-url": "u", "url": "u", "id": "b"},
    }


def write_snapshot(root: Path, as_of: str, accounts: list[dict]) -> Path:
    """A pretty-printed document in the dated folder layout."""
    when = at(as_of)
    folder = root / "transactions" / f"{when:%Y/%m/%d}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{when:%Y-%m-%dT%H%M%S}Z_bd{int(when.timestamp())}.json"
    path.write_text(json.dumps({"errors": [], "accounts": accounts}, indent=4))
    return path
