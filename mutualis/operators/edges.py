"""Edge-table operators: adjacency → edges, clean edges, degrees, reciprocated pairs.

A graph is a DataFrame of directed edges ``(src, dst)``: user ``src`` lists ``dst``. Working on edge
rows, not on whole lists, keeps every step a shuffle of bounded rows however large a list grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges_from_adjacency(adj: DataFrame, user: str = "userid", friends: str = "friend_list") -> DataFrame:
    """One row per listed friend, ``(src, dst)``. Empty lists give no row."""
    return adj.select(F.col(user).alias("src"), F.explode(F.col(friends)).alias("dst"))


def proper_edges(edges: DataFrame) -> DataFrame:
    """Directed edges without self-listings or null ends (D2); repeated edges stay."""
    return edges.select("src", "dst").where(
        F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))


def clean_edges(edges: DataFrame) -> DataFrame:
    """Distinct proper edges.

    One shuffle on ``(src, dst)`` with map-side de-duplication; later joins on the same key reuse it.
    """
    return proper_edges(edges).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    """``(src, deg)``: number of distinct ids on each user's list (input: clean edges)."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))


def distinct_links(edges: DataFrame) -> DataFrame:
    """``(id1, id2, up, down)``: every unordered pair with a link, once; up: id1 lists id2, down: the other way.

    Each edge is sent to the key ``(least, greatest)``, at most one row per pair and task. Repeated
    edges and self-listings do no harm, so the input need not be clean. No id is a key here, so a hub
    is spread over all tasks.
    """
    up = F.col("src") < F.col("dst")
    return (proper_edges(edges)
            .groupBy(F.least("src", "dst").alias("id1"), F.greatest("src", "dst").alias("id2"))
            .agg(F.max(up).alias("up"), F.max(~up).alias("down")))


def directed(links: DataFrame) -> DataFrame:
    """The distinct edges ``(src, dst)`` of distinct links."""
    both = F.array(F.struct(F.col("id1").alias("src"), F.col("id2").alias("dst"), F.col("up").alias("on")),
                   F.struct(F.col("id2").alias("src"), F.col("id1").alias("dst"), F.col("down").alias("on")))
    return links.select(F.explode(both).alias("e")).where("e.on").select("e.src", "e.dst")


def reciprocal_pairs(edges: DataFrame) -> DataFrame:
    """Pairs ``id1 < id2`` listed both ways, met under the canonical key in one shuffle."""
    return distinct_links(edges).where("up and down").select("id1", "id2")


def reciprocal_pairs_by_self_join(edges: DataFrame) -> DataFrame:
    """The same pairs as a self equi-join of the (clean) edges with their ends swapped."""
    a = edges.select(F.col("src").alias("id1"), F.col("dst").alias("id2")).where("id1 < id2")
    b = edges.select(F.col("dst").alias("id1"), F.col("src").alias("id2"))
    return a.join(b, ["id1", "id2"], "left_semi")
