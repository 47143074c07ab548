"""Time the DuckDB oracle SQL of the headline queries on one machine, for comparison with bench.py.

Usage: python scripts/time_oracles.py [sf_dir]. Prints one JSON line like bench.py (best of three
after one untimed run). DuckDB runs in-process on all cores; it is a single-node comparison point,
not part of the rebuild.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from mutualis.plans import ORACLES  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("part", "lineitem", "orders", "customer", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    times = {}
    for name in HEADLINE:
        sql = ORACLES[name]
        con.execute(sql).fetchall()
        best = None
        for _ in range(3):
            t = time.perf_counter()
            con.execute(sql).fetchall()
            dt = time.perf_counter() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "duckdb_oracle_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
