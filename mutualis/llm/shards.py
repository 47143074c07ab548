"""Sharding by Karmarkar-Karp differencing: near-equal bytes with equal texts kept together.

Differencing: every group starts as a partial partition (its weight in one part, nothing in the
others); the two partial partitions with the largest spread are combined, the heaviest part of one
with the lightest of the other, until one is left.

The groups are reduced level by level, at least once, in Spark. Heavy groups (over 1/HEAVY_SHARE of all bytes, so
fewer than HEAVY_SHARE of them) go on as they are, and so does one block of light groups, for the
fine balance at the end. The other light groups are dealt into blocks by their hash, and each block
is differenced, in a task of its own, into BUNDLES bundles of near-equal bytes. Bundles are the
next level's groups. The driver only ever differences what such levels leave: heavy groups, one block
of light ones and bundles, at most LAST_GROUPS in all (levels are added until that holds). The parts are
joined back down the levels. Shard numbers depend on BLOCK_GROUPS, BUNDLES and HEAVY_SHARE.

An empty table gives no rows. A text of any length is one row's size and digests; texts are not moved
beyond the first projection. Other columns of the table, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import current_scope, materialize, scratch_scope

LAST_GROUPS = 32_768   # heavy groups, light groups of one block and bundles on the driver, at most
BLOCK_GROUPS = 8_192   # groups of a block, about
BUNDLES = 64           # bundles a block is reduced to
HEAVY_SHARE = 4_096    # groups over this part of the bytes are not bundled
SLOT_ROWS = 20_000     # rows numbered in one window, about


def differencing(weights: list[int], parts: int) -> list[int]:
    """The part of each weight after Karmarkar-Karp differencing; ties by position."""
    n = len(weights)
    if n == 0:
        return []
    parent = list(range(n))  # trees of weights that ended up in the same part

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # A partial partition: sums in ascending order, and one member of each part (-1: empty).
    heap = [(-int(w), i, None, None) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    seq = n

    def open_up(item):
        spread, i, sums, heads = item
        if sums is None:
            sums = np.zeros(parts, np.int64)
            heads = np.full(parts, -1, np.int64)
            sums[-1], heads[-1] = -spread, i
        return sums, heads

    while len(heap) > 1:
        (s1, h1), (s2, h2) = open_up(heapq.heappop(heap)), open_up(heapq.heappop(heap))
        s2, h2 = s2[::-1], h2[::-1]
        both = np.flatnonzero((h1 >= 0) & (h2 >= 0))
        for k in both.tolist():
            parent[root(int(h2[k]))] = root(int(h1[k]))
        sums, heads = s1 + s2, np.maximum(h1, h2)
        order = np.argsort(sums, kind="stable")
        sums, heads = sums[order], heads[order]
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), seq, sums, heads))
        seq += 1
    _, heads = open_up(heap[0])
    part = {root(int(h)): k for k, h in enumerate(heads.tolist()) if h >= 0}
    return [part[root(i)] for i in range(n)]


def _level(groups: DataFrame, n: int, total: int, level: int):
    """One reduction: (parents: id -> parent, the next level's groups: id, weight)."""
    blocks = max(2, -(-n // BLOCK_GROUPS))
    bundles = max(2, min(BUNDLES, BLOCK_GROUPS // 16))
    heavy = F.col("weight") * HEAVY_SHARE > total
    block = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(blocks))
    placed = groups.withColumn("block", F.when(heavy, -1).otherwise(block))

    def bundle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["weight", "id"], ascending=[False, True], kind="stable")
        part = differencing(rows["weight"].tolist(), bundles)
        name = [f"{level}:{key[0]}:{p}" for p in part]
        return pd.DataFrame({"id": rows["id"].to_numpy(), "weight": rows["weight"].to_numpy(), "parent": name})

    light = placed.where("block > 0").groupBy("block").applyInPandas(bundle, "id string, weight long, parent string")
    light = materialize(light, f"bundles{level}")
    alone = placed.where("block <= 0").select("id", "weight")
    return light.select("id", "parent"), alone.union(
        light.groupBy(F.col("parent").alias("id")).agg(F.sum("weight").alias("weight")))


def assign_groups(groups: DataFrame, parts: int) -> DataFrame:
    """``(id, shard)`` for every row of ``groups(id string, weight long)``, ids unique."""
    spark, parents = groups.sparkSession, []
    measured = {"n": F.count(F.lit(1)), "total": F.sum("weight")}
    level, (cur, stats) = 0, materialize(groups.select("id", "weight"), "groups", measured)
    while level == 0 or stats["n"] > LAST_GROUPS:
        up, nxt = _level(cur, stats["n"], stats["total"] or 0, level)
        parents.append((cur.select("id"), up))
        last, level = stats["n"], level + 1
        cur, stats = materialize(nxt, "groups", measured)
        if stats["n"] > LAST_GROUPS and stats["n"] >= last:
            raise RuntimeError(f"bundling did not reduce {last} groups")
    rows = sorted(((r["weight"], r["id"]) for r in cur.collect()), key=lambda r: (-r[0], r[1]))
    shard = differencing([w for w, _ in rows], parts)
    out = spark.createDataFrame(pd.DataFrame({"id": [i for _, i in rows], "shard": np.array(shard, np.int32)}),
                                "id string, shard int")
    for ids, up in reversed(parents):
        named = ids.join(up, "id", "left").select("id", F.coalesce("parent", "id").alias("parent"))
        out = named.join(out.withColumnRenamed("id", "parent"), "parent").select("id", "shard")
    return materialize(out, "group_shards")


def shard_documents(docs: DataFrame, parts: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``.

    size: the text's UTF-8 bytes plus 1 (null text: 1; its checksum is that of no bytes, 0). Equal
    texts are one group and share a shard; null texts are a group of their own. slot numbers a
    shard's rows from 0 without a gap, ordered by a hash block, then doc_id; repeated rows get
    different slots. law is always ``bytes``, so grown_shard is null.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    held = current_scope()
    with scratch_scope(docs.sparkSession):
        rows = materialize(docs.select(
            F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw.cast("binary")).alias("text_crc32"),
            F.when(F.col(text).isNull(), "null").otherwise(F.sha2(raw, 256)).alias("id")), "sized")
        groups = rows.groupBy("id").agg(F.sum("size").alias("weight"))
        placed = rows.join(assign_groups(groups, parts), "id").drop("id")
        placed, stats = materialize(placed, "placed", {"n": F.count(F.lit(1))}, held)
    blocks = max(1, -(-stats["n"] // (SLOT_ROWS * parts)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)))
    # Gapless numbers without a window over a whole shard: count each (shard, block), add up the
    # blocks before, number inside the block.
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.selectExpr("shard", "block", "sum(n) over (partition by shard order by block) - n as before")
    slot = "row_number() over (partition by shard, block order by doc_id, text_crc32, size) - 1"
    numbered = placed.selectExpr("*", f"{slot} as inner_slot").join(before, ["shard", "block"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("inner_slot")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
