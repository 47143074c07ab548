"""Connected components of a link table, as Spark jobs (large-star and small-star rounds).

Every round is a join-free pair of group-bys over the links; links and labels stay in tables. A
node's links are never gathered in one row: the smallest neighbour is an aggregate, joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star round: every node sends its larger (large star) or its smaller neighbours and
    itself (small star) to its smallest neighbour."""
    if large:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(lowest, "u")
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            lowest.select("u", F.col("m").alias("v")))
    return new.where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with a link; component is its smallest reachable node.

    Null ends and self links are no links. Rounds are written to the shared folder, so a lost
    executor costs re-reading files only; the number of rounds grows with the logarithm of the
    longest shortest path.
    """
    cur = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(
        "u is not null and v is not null and u <> v").distinct()
    digest = {"n": F.count(F.lit(1)), "s": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    cur, last = materialize(cur, "links", digest)
    for _ in range(MAX_ROUNDS):
        cur = materialize(_star(cur, True), "large")
        cur, now = materialize(_star(cur, False), "small", digest)
        if (now["n"], now["s"]) == (last["n"], last["s"]):
            nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        last = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
