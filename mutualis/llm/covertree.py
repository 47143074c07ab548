"""Exact top-k inner-product search with dual cover trees.

Data and queries are indexed together: pivots (a bounded set of rows) deal all rows into cells, and
each cell's rows into blocks of about BLOCK_ROWS. A block's task builds a cover tree over its data
and one over the queries it is given, and walks both at once: a pair of nodes is pruned when no
point under the one can reach the worst k-th score of the queries under the other. For centers c, d
and covering radii r, s, <q, x> is at most <c, d> + r|d| + s|c| + rs.

First every query group searches its own block; that gives each query a k-th score to beat. Then
the same bound over whole cells says which cells a query cell still has to visit, and the queries,
in chunks, go to the blocks of those cells. The k best of all a query's blocks are its answer.

Components become floor(256 x) as whole numbers, so scores are exact: in floating point while
products stay below 2^53, else in Python integers. Vectors that are null, hold a null or a
non-finite component, or have no id take no part; an id's rows count once, with its smallest vector.
Only vectors of the same length are compared. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import current_scope, materialize, scratch_scope

K = 5
SCALE = 256
LEAF = 24               # points of a tree leaf
BLOCK_ROWS = 1024       # rows of a block, about
MAX_CELLS = 1024        # pivots; the bound on what is broadcast and kept by the driver
QUERY_CHUNK = 1024      # queries that go to a block at once, about
_SLACK = 1e-6           # rounding of the bounds, relative


class Node:
    """A cover tree node: every point under it is within ``radius`` of its center, and the centers
    of its children are more than half its level's scale apart."""
    __slots__ = ("center", "radius", "points", "kids")

    def __init__(self, center: int, radius: float):
        self.center, self.radius = center, radius
        self.points, self.kids = np.zeros(0, np.int64), []


def build(x: np.ndarray) -> Node | None:
    """The cover tree over the rows of ``x``. Children that are single points are kept as the
    node's ``points``; a set of LEAF points or of equal ones is not divided further."""
    if not len(x):
        return None

    def distance(of: np.ndarray, to: int) -> np.ndarray:
        gap = x[of] - x[to]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    all_points = np.arange(len(x))
    far = distance(all_points, 0)
    root = Node(0, float(far.max()))
    todo = [(root, all_points, far)]
    while todo:
        node, points, far = todo.pop()
        if len(points) <= LEAF or node.radius == 0:
            node.points = points
            continue
        half = 2.0 ** (np.ceil(np.log2(node.radius)) - 1)
        single, left, center, near = [], points, node.center, far
        while True:
            inside = near <= half
            mine, mine_far, left = left[inside], near[inside], left[~inside]
            if len(mine) == 1:
                single.append(center)
            else:
                kid = Node(center, float(mine_far.max()))
                node.kids.append(kid)
                todo.append((kid, mine, mine_far))
            if not len(left):
                break
            center = int(left[0])
            near = distance(left, center)
        node.points = np.array(single, np.int64)
    return root


class Best:
    """The k best candidates so far of every query of a block."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.bar = floor.copy()  # a candidate below it cannot be among the k best
        self.score = [np.zeros(0)] * len(ids)
        self.found = [np.zeros(0, np.int64)] * len(ids)

    def offer(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray):
        """Scores of some queries (rows) against some ids (columns)."""
        hit = (scores >= self.bar[queries][:, None]) & (ids[None, :] != self.ids[queries][:, None])
        for r in np.flatnonzero(hit.any(axis=1)):
            q, some = queries[r], np.flatnonzero(hit[r])
            score = np.concatenate([self.score[q], scores[r, some]])
            found = np.concatenate([self.found[q], ids[some]])
            order = np.lexsort((found, -score if score.dtype != object else [-s for s in score]))[:self.k]
            self.score[q], self.found[q] = score[order], found[order]
            if len(order) == self.k:
                self.bar[q] = max(self.bar[q], self.score[q][-1])


def dual_search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, data: np.ndarray,
                data_ids: np.ndarray, k: int):
    """``(query row, data id, score)`` of the k best of ``data`` for every query, leaving out those
    below the query's ``floor`` and rows with the query's id."""
    best = Best(query_ids, floor, k)
    top = max(float(np.abs(queries).max(initial=0)), float(np.abs(data).max(initial=0)))
    exact = top * top * max(1, data.shape[1]) < 2.0 ** 53
    qx, dx = queries.astype(np.float64), data.astype(np.float64)
    q_norm, d_norm = np.sqrt((qx ** 2).sum(axis=1)), np.sqrt((dx ** 2).sum(axis=1))
    q_tree, d_tree = build(qx), build(dx)

    def score(qs: np.ndarray, ds: np.ndarray):
        if exact:
            return qx[qs] @ dx[ds].T
        return queries[qs].astype(object) @ data[ds].astype(object).T

    def under(node: Node) -> np.ndarray:
        parts, todo = [], [node]
        while todo:
            n = todo.pop()
            parts.append(n.points)
            todo += n.kids
        return np.concatenate(parts)

    def bounds(center: int, radius: float, nodes: list[Node]) -> np.ndarray:
        at = np.array([n.center for n in nodes])
        r = np.array([n.radius for n in nodes])
        b = dx[at] @ qx[center] + radius * d_norm[at] + r * q_norm[center] + radius * r
        return b + _SLACK * (1 + np.abs(b))

    # A query group is a leaf's queries or a node's single children; data nodes are visited from
    # the highest bound down until the bound falls below the group's worst k-th score.
    def group(qs: np.ndarray, center: int, radius: float, nodes: list[Node]):
        open_nodes = list(zip(bounds(center, radius, nodes), nodes)) if nodes else []
        while open_nodes:
            at = max(range(len(open_nodes)), key=lambda i: open_nodes[i][0])
            b, node = open_nodes.pop(at)
            if b < float(best.bar[qs].min()):
                return
            if len(node.points):
                best.offer(qs, score(qs, node.points), data_ids[node.points])
            if node.kids:
                open_nodes += zip(bounds(center, radius, node.kids), node.kids)

    todo = [(q_tree, [d_tree])] if q_tree is not None and d_tree is not None else []
    while todo:
        q_node, nodes = todo.pop()
        if len(q_node.points):
            radius = q_node.radius
            group(q_node.points, q_node.center, radius, nodes)
        for kid in q_node.kids:
            # Descend on the data side while its nodes are wider than the query node.
            alive, check = [], list(nodes)
            worst = float(best.bar[under(kid)].min())
            while check:
                b = bounds(kid.center, kid.radius, check)
                check, nxt = [n for n, v in zip(check, b) if v >= worst], []
                for n in check:
                    if n.kids and n.radius > kid.radius and not len(n.points):
                        nxt += n.kids
                    else:
                        alive.append(n)
                check = nxt
            todo.append((kid, alive))
    rows = np.repeat(np.arange(len(query_ids)), [len(f) for f in best.found])
    ids = np.concatenate([np.zeros(0, np.int64), *best.found])
    scores = np.array([int(s) for part in best.score for s in part], np.int64)
    return rows, ids, scores


def quantised(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, v array<long>)`` of the rows that take part."""
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    rows = rows.select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _search_cells(rows: DataFrame, n: int, k: int) -> DataFrame:
    """``(query_id, vec_id, score)``: candidates that hold every query's k best. ``rows``: a written
    table ``(vec_id, v, is_query)`` of n vectors of one length."""
    spark = rows.sparkSession
    cells = min(MAX_CELLS, max(1, -(-n // BLOCK_ROWS)))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(cells).select("v").collect()
    pivots = np.array([r["v"] for r in picked], np.float64).reshape(len(picked), -1)

    def place(batches):
        size = (pivots ** 2).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v")).astype(np.float64)
            cell = np.argmin(size[None, :] - 2 * x @ pivots.T, axis=1)
            far = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("vec_id", "v", "is_query")], pa.array(cell.astype(np.int32)), pa.array(far)],
                names=["vec_id", "v", "is_query", "cell", "far"])

    placed = materialize(rows.select("vec_id", "v", "is_query").mapInArrow(
        place, "vec_id long, v array<long>, is_query boolean, cell int, far double"), "cells")
    stats = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_query").cast("long")).alias("q"), F.max("far").alias("radius"),
        F.max(F.when(F.col("is_query"), F.col("far"))).alias("query_radius")).toPandas().set_index("cell")
    blocks = {int(c): max(1, -(-int(s.n) // BLOCK_ROWS)) for c, s in stats.iterrows()}

    def by_cell(values: dict, kind: str) -> Column:
        """A value per cell, as an array looked up by the cell's number (at most MAX_CELLS long)."""
        table = F.array(*[F.lit(values.get(c)).cast(kind) for c in range(len(pivots))])
        return F.get(table, F.col("cell"))

    placed = placed.withColumn("sub", F.pmod(F.xxhash64("vec_id"), by_cell(blocks, "long")).cast("int"))

    def search(table: pa.Table) -> pa.Table:
        data = table.filter(table.column("is_data"))
        asks = table.filter(table.column("is_query"))
        rows, ids, scores = dual_search(
            _matrix(asks.column("v")), asks.column("vec_id").to_numpy(), asks.column("bar").to_numpy(),
            _matrix(data.column("v")), data.column("vec_id").to_numpy(), k)
        return pa.table({"query_id": asks.column("vec_id").to_numpy()[rows], "vec_id": ids, "score": scores})

    out = "query_id long, vec_id long, score long"
    none = F.lit(float("-inf"))
    home = placed.select("cell", "sub", "vec_id", "v", F.lit(True).alias("is_data"), "is_query", none.alias("bar"))
    found = materialize(home.groupBy("cell", "sub").applyInArrow(search, out), "home_best")
    if sum(blocks.values()) == 1:
        return found

    # The k-th score of every query in its own block, and the worst of every query cell.
    bars = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bar")).where(
        F.col("n") >= k).select(F.col("query_id").alias("_id"), F.col("bar").cast("double").alias("bar"))
    asks = placed.where("is_query").join(bars, F.col("vec_id") == F.col("_id"), "left").select(
        "vec_id", "v", "cell", "sub", F.coalesce("bar", none).alias("bar"))
    asks = materialize(asks, "queries")
    worst = {r["cell"]: r["worst"] for r in asks.groupBy("cell").agg(F.min("bar").alias("worst")).collect()}
    norm = np.sqrt((pivots ** 2).sum(axis=1))
    here = sorted(worst)
    rq, rd = stats.query_radius.reindex(here).to_numpy(), stats.radius.reindex(sorted(blocks)).to_numpy()
    there = np.array(sorted(blocks))
    bound = pivots[here] @ pivots[there].T + rq[:, None] * norm[there] + norm[here][:, None] * rd + rq[:, None] * rd
    visit = bound + _SLACK * (1 + np.abs(bound)) >= np.array([worst[c] for c in here])[:, None]

    # Chunks of queries: neighbouring query cells together, a large cell in parts.
    chunk, parts, size = {}, {}, 0
    number = 0
    for c in here:
        q = int(stats.q[c])
        if size and size + q > QUERY_CHUNK:
            number, size = number + 1, 0
        chunk[c], parts[c], size = number, max(1, -(-q // QUERY_CHUNK)), size + q
        number += parts[c] - 1
    to_cells, to_chunks = {}, {}
    for i, c in enumerate(here):
        to_cells[c] = [int(d) for j, d in enumerate(there) if visit[i, j]]
        for j, d in enumerate(there):
            if visit[i, j]:
                to_chunks.setdefault(int(d), set()).update(range(chunk[c], chunk[c] + parts[c]))
    routes = pd.DataFrame([(c, chunk[c], parts[c], d, blocks[d]) for c in here for d in to_cells[c]],
                          columns=["cell", "chunk", "parts", "to_cell", "to_blocks"])
    copies = pd.DataFrame([(d, x) for d, xs in to_chunks.items() for x in sorted(xs)], columns=["cell", "chunk"])
    # Written, so that the planner knows their sizes.
    routes = materialize(spark.createDataFrame(
        routes, "cell int, chunk int, parts int, to_cell int, to_blocks int").coalesce(1), "routes")
    copies = materialize(spark.createDataFrame(copies, "cell int, chunk int").coalesce(1), "copies")
    routed = asks.join(routes, "cell").withColumn("to_sub", F.explode(F.expr("sequence(0, to_blocks - 1)")))
    sent = routed.where("not (cell = to_cell and sub = to_sub)").select(
        (F.col("chunk") + F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))).cast("int").alias("chunk"),
        F.col("to_cell").alias("cell"), F.col("to_sub").alias("sub"), "vec_id", "v",
        F.lit(False).alias("is_data"), F.lit(True).alias("is_query"), "bar")
    met = placed.join(copies, "cell").select(
        "chunk", "cell", "sub", "vec_id", "v", F.lit(True).alias("is_data"), F.lit(False).alias("is_query"), none.alias("bar"))
    return found.union(met.union(sent).groupBy("chunk", "cell", "sub").applyInArrow(search, out))


def top_k(df: DataFrame, every: int = 50, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by ``every``, its k
    highest inner products over all other ids (all of them if there are fewer)."""
    rows = quantised(df, vec_id, vector).withColumn("is_query", F.col("vec_id") % every == 0)
    found = df.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    held = current_scope()
    with scratch_scope(df.sparkSession):
        rows = materialize(rows.withColumn("dim", F.size("v")), "vectors")
        for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
            found = found.union(_search_cells(rows.where(F.col("dim") == r["dim"]), r["n"], k))
        found = materialize(found, "candidates", scope=held)
    ranked = found.selectExpr(
        "query_id", "row_number() over (partition by query_id order by score desc, vec_id) as rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
