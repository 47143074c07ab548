"""Benchmark the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_SHUFFLE_PARTITIONS (default 2 x cpus; AQE coalesces), BENCH_DRIVER_MEMORY (default 16g).
Each query is run to completion with the ``noop`` sink (every row computed, nothing collected);
the reported time per query is the best of BENCH_RUNS runs after one untimed warm-up pass over all
of them (steady state: JIT-compiled JVM, generated code cached). Graphs that queries share are
released before every run, so each time includes preparing its graph.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mutualis.session import local_session  # noqa: E402

HEADLINE = [
    "q1_mutual_counts",
    "q1_mutual_counts_cosupply",
    "q1_from_text",
    "q1_mixed",
    "q2_top_pairs",
    "q2_mixed",
    "q3_ratings_keyed",
    "q3_ratings_pairs",
    "q4_top_rated",
    "q4_top_rated_dedup",
    "q4_top_by_key",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus)))
    spark = local_session(cores=cpus, shuffle_partitions=partitions, app="mutualis-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    from mutualis.plans import QUERIES, catalog
    from mutualis.session import drop_scratch

    def run(name):
        catalog.release_graphs(spark)
        drop_scratch(spark)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up pass: JVM start-up, JIT and code generation (not timed)
        run(name)
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(name) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
