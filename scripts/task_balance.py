"""Per-stage task balance of Q1 on the hub graph (or a registered query), from Spark's event log.

Usage: python scripts/task_balance.py [--no-coalesce] [sf_dir] [query | hot_business].
Writes the event log to a fresh folder under /tmp, runs the job once, and prints for every stage
that reads at least 20,000 records: the number of tasks, records read (max / median per task) and task time (max / median). A hot key
processed by one task shows up as max far above median.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mutualis.session import local_session  # noqa: E402


def balance(log_dir: str) -> list[str]:
    tasks: dict[int, list[tuple[int, int]]] = {}
    for f in glob.glob(os.path.join(log_dir, "**"), recursive=True):
        if not os.path.isfile(f):
            continue
        with open(f) as fh:
            for line in fh:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                ev = json.loads(line)
                m = ev.get("Task Metrics") or {}
                recs = m["Shuffle Read Metrics"]["Total Records Read"] + m["Input Metrics"]["Records Read"]
                dur = ev["Task Info"]["Finish Time"] - ev["Task Info"]["Launch Time"]
                tasks.setdefault(ev["Stage ID"], []).append((recs, dur))
    out = []
    for sid, ts in sorted(tasks.items()):
        recs = [r for r, _ in ts]
        durs = [d for _, d in ts]
        if sum(recs) < 20_000:
            continue
        out.append(f"stage {sid:3d}: {len(ts):3d} tasks, {sum(recs):10d} records, per task max/median "
                   f"{max(recs)}/{int(statistics.median(recs))} records, "
                   f"{max(durs)}/{int(statistics.median(durs))} ms")
    return out


def hot_business(spark, sf_dir):
    """Q3 and Q4 over reviews where one business matching the address text holds half of all
    review lines (every line copied once more under that business's id)."""
    from pyspark.sql import functions as F

    from mutualis.operators import ratings_for, top_rated
    from mutualis.sources import tables
    b = tables.businesses(spark, sf_dir)
    r = tables.reviews(spark, sf_dir)
    hot = b.where(F.col("address").contains("red")).agg(F.min("businessid")).first()[0]
    skewed = r.unionByName(r.select("reviewid", "userid", F.lit(hot).alias("businessid"), "stars"))
    q3 = ratings_for(b, skewed, "red", match="like").select(F.lit("q3").alias("q"), "userid")
    q4 = top_rated(skewed, b, 10).select(F.lit("q4").alias("q"), F.col("businessid").alias("userid"))
    return q3.unionByName(q4)


def main():
    args = sys.argv[1:]
    # --no-coalesce: keep every shuffle partition, to see how keys spread (at this size AQE would
    # otherwise merge small partitions into one or two tasks).
    extra = {"spark.sql.adaptive.coalescePartitions.enabled": "false"} if "--no-coalesce" in args else {}
    args = [a for a in args if a != "--no-coalesce"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    name = args[1] if len(args) > 1 else None
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = local_session(8, 16, app="mutualis-balance", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", **extra})
    if name == "hot_business":
        df = hot_business(spark, sf_dir)
    elif name:
        from mutualis.plans import QUERIES
        df = QUERIES[name](spark, sf_dir)
    else:
        from measure_routing import with_hub

        from mutualis.operators import mutual_counts
        df = mutual_counts(with_hub(spark, sf_dir))
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    print(f"{name or 'Q1 on cosupply + hub'}: {time.perf_counter() - t:.2f} s")
    spark.stop()
    print("\n".join(balance(log_dir)))


if __name__ == "__main__":
    main()
