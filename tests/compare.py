"""Run registered queries and their oracle side by side."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when both engines agree, else a short description."""
    df = query(spark, sf_dir)
    got = bag(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = bag(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra, lost = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())};"
            f" only spark {list(extra.items())[:2]}; only oracle {list(lost.items())[:2]}"
        )
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        started = time.time()
        try:
            problem = difference(spark, con, name, query, oracle[name], sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        rows = con.execute(f"SELECT count(*) FROM ({oracle[name]})").fetchone()[0] if problem is None else "-"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
