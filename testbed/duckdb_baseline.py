"""Time the oracle's building blocks and reports in DuckDB, stage by stage.

    python testbed/duckdb_baseline.py /root/testdata/sf0.1

Each block becomes a table, as each model is a stored table in a build; the
selects then run over those tables.
"""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from testbed.oracle import BLOCKS, SELECTS  # noqa: E402

SOURCES = "region nation customer supplier part orders lineitem".split()
ORDER = (
    "ledger fact catalog rates merchant days pay one_each expenses income unknown"
    " overunder savings mom accounts listing recent_income as_of_days"
).split()


def main() -> None:
    sf_dir = sys.argv[1]
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name in ORDER:
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TABLE {name} AS {BLOCKS[name]}")
            runs.append(time.perf_counter() - started)
        print(f"block {name:32s}{statistics.median(runs):8.3f}", flush=True)
    for name, select in SELECTS.items():
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            con.execute(select).fetchall()
            runs.append(time.perf_counter() - started)
        print(f"query {name:32s}{statistics.median(runs):8.3f}", flush=True)


if __name__ == "__main__":
    main()
