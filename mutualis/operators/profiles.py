"""The top-k pairs with both members' profiles.

The original attaches profiles with a join on ``userid = id1 OR userid = id2`` (a nested-loop
plan) or with one lookup job per id. Here the k pairs become 2k member rows
(``posexplode(array(id1, id2))``) and meet the profiles in one equi-join. The limit gives the
planner the size of the 2k rows, so it broadcasts them while they are few, whatever ``k`` asks for;
then the profile table is streamed once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.schemas import DEFAULT_TOP_K
from .topk import sort_bounded, top_k

PROFILE_FIELDS = ("firstname", "lastname", "address")
OUT_FIELDS = ("first", "last", "address")
HOW = ("inner", "left")


def top_pairs(counts: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """T2 on pair counts: most shared first, ties by ``id1``, ``id2``."""
    return top_k(counts, k, [F.col("n").desc()], ["id1", "id2"])


def pair_members(pairs: DataFrame) -> DataFrame:
    """J6 rewrite: one row per pair member, ``pos`` 0 for ``id1`` (side A), 1 for ``id2`` (side B)."""
    return pairs.select("id1", "id2", "n",
                        F.posexplode(F.array("id1", "id2")).alias("pos", "userid"))


def attach_profiles(pairs: DataFrame, profiles: DataFrame, how: str = "inner",
                    fields: tuple[str, ...] = PROFILE_FIELDS) -> DataFrame:
    """Pairs ``(id1, id2, n)`` of bounded count → ``(id1, id2, n, a_*, b_*)``.

    ``inner`` keeps a pair only when both members have a profile; ``left`` keeps every pair with
    nulls for a missing member (D8). A member with several profile lines gets the smallest one.
    One join (the 2k member rows against the profiles) and one aggregation
    over at most 2k rows plus matches.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    if how == "left":
        # The pairs are read twice below; write the (at most k) rows once so the ranking upstream
        # runs once.
        pairs = materialize(pairs, "ranked_pairs")
    members = pair_members(pairs)
    prof = profiles.select("userid", F.struct(*fields).alias("p"))
    found = prof.join(members, "userid").select("id1", "id2", "n", "pos", "p")
    if how == "left":
        # The pairs themselves, with no profile, so that a pair whose members both lack one survives.
        bare = pairs.select("id1", "id2", "n", F.lit(None).cast("int").alias("pos"),
                            F.lit(None).cast(prof.schema["p"].dataType).alias("p"))
        found = found.unionByName(bare)
    res = (found.groupBy("id1", "id2", "n")
           .agg(F.min(F.when(F.col("pos") == 0, F.col("p"))).alias("a"),
                F.min(F.when(F.col("pos") == 1, F.col("p"))).alias("b")))
    if how == "inner":
        res = res.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    names = OUT_FIELDS if tuple(fields) == PROFILE_FIELDS else tuple(fields)
    out = [F.col(f"{side}.{src}").alias(f"{side}_{dst}")
           for side in ("a", "b") for src, dst in zip(fields, names)]
    return res.select("id1", "id2", "n", *out)


def top_pairs_with_profiles(counts: DataFrame, profiles: DataFrame, k: int = DEFAULT_TOP_K,
                            how: str = "inner") -> DataFrame:
    """``(n, a_first, a_last, a_address, b_first, b_last, b_address)`` plus the ids, ranked."""
    res = attach_profiles(top_pairs(counts, k), profiles, how)
    return sort_bounded(res, [F.col("n").desc()], ["id1", "id2"])  # at most k pairs, one row each
