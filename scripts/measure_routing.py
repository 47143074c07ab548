"""Time the two ways of counting shared neighbours, and the routed mix, on both test graphs.

Usage: python scripts/measure_routing.py [sf_dir] [graph ...]. Prints one line per (graph, setting): best of
three steady-state runs (after one untimed run), including the writes of the intermediates.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mutualis.operators import mutual_counts  # noqa: E402
from mutualis.session import local_session  # noqa: E402
from mutualis.sources import tables  # noqa: E402

SETTINGS = {
    "arrays": dict(strategy="arrays"),
    "probe": dict(strategy="probe"),
    "auto (hub 1000, balance 4)": dict(hub_degree=1000),
    "auto (default: hub 256, balance 4)": dict(),
    "auto (hub 1000, balance 1000)": dict(hub_degree=1000, balance=1000.0),
    "auto (hub 64, balance 4)": dict(hub_degree=64),
}


def with_hub(spark, sf_dir):
    """``cosupply`` plus one id (-1) linked both ways to every lineitem's part: a hub holding over
    a third of all links (the skew case)."""
    from pyspark.sql import functions as F
    co = tables.cosupply(spark, sf_dir)
    parts = tables.supplies(spark, sf_dir).select("src")
    hub = F.lit(-1).cast("bigint")
    return co.unionByName(parts.select("src", hub.alias("dst"))).unionByName(
        parts.select(hub.alias("src"), F.col("src").alias("dst")))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    only = sys.argv[2:]
    spark = local_session(8, 16, app="mutualis-routing")
    graphs = {"supplies": tables.supplies, "cosupply": tables.cosupply, "hub": with_hub}
    for graph, make in graphs.items():
        if only and graph not in only:
            continue
        edges = make(spark, sf_dir)
        for label, kw in SETTINGS.items():
            def run():
                t = time.perf_counter()
                mutual_counts(edges, **kw).write.format("noop").mode("overwrite").save()
                return time.perf_counter() - t
            run()
            print(f"{graph:9s} {label:30s} {min(run() for _ in range(3)):6.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
