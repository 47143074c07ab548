"""Row-form list operators on any adjacency layout.

A user's list may be one line or several, its ids in any order and repeated. Lists are exploded,
cut into blocks by each *id* (``id div block``) and gathered per (user, block), so a gathered list
holds at most ``block`` ids; membership and intersection work block by block, and answers about a
user or a pair are aggregated back over the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, current_scope, materialize, shuffles_dropped
from .edges import clean_edges, edges_from_adjacency, proper_edges, reciprocal_pairs

DEFAULT_BLOCK = 1024
ROUND_ROWS = 1 << 21  # masks that one job of the bitmap way sends, at least
BLOCK_ROUNDS = 4


def block_of(c: str, block: int) -> Column:
    """The block that the id in column ``c`` lies in (block 0 reaches to both sides of 0)."""
    return F.expr(f"`{c}` div {int(block)}")


def list_blocks(adj: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(userid, blk, ids)``: the distinct ids of a user in one block, ascending. Users without
    friends have no row."""
    e = edges_from_adjacency(adj).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return (e.groupBy(F.col("src").alias("userid"), block_of("dst", block).alias("blk"))
            .agg(F.array_sort(F.collect_set("dst")).alias("ids")))


def users_of(adj: DataFrame) -> DataFrame:
    """Every user with a line, once."""
    return adj.select("userid").where(F.col("userid").isNotNull()).distinct()


def whole_lists(adj: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(userid, friend_list)``: one row per user with a line, its distinct ids ascending, as the
    one-line-per-user layout has it. Such a row is as long as the user's list; use blocks where
    lists have no bound."""
    lists = list_blocks(adj, block).groupBy("userid").agg(F.array_sort(F.flatten(F.collect_list("ids"))).alias("l"))
    none = F.expr("cast(array() as array<bigint>)")
    return users_of(adj).join(lists, "userid", "left").select("userid", F.coalesce("l", none).alias("friend_list"))


def list_sizes(adj: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(userid, n)``, the number of distinct ids on each user's list, 0 for an empty one."""
    sizes = list_blocks(adj, block).groupBy("userid").agg(F.sum(F.size("ids")).alias("n"))
    return users_of(adj).join(sizes, "userid", "left").select("userid", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def lists_contain(adj: DataFrame, asked: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(userid, id, found)`` for each asked ``(userid, id)`` of a user with a line: only the
    block that would hold the id is looked at."""
    blocks = list_blocks(adj, block).select(F.col("userid").alias("u"), "blk", "ids")
    known = asked.join(users_of(adj), "userid", "left_semi").withColumn("b", block_of("id", block))
    return known.join(blocks, (F.col("userid") == F.col("u")) & (F.col("b") == F.col("blk")), "left").select(
        "userid", "id", F.coalesce(F.array_contains("ids", F.col("id")), F.lit(False)).alias("found"))


def first_ids(adj: DataFrame, k: int, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(userid, ids)``, the k smallest distinct ids of each user's list.

    The ids stay rows: the k smallest of each (user, block), then of each user, which the planner limits in
    each task before the shuffle as well as after it. So no row holds more than k ids, and a user's
    group k for each block and task at most."""
    e = edges_from_adjacency(adj).where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()
    for by in ([F.col("src"), block_of("dst", block)], [F.col("src")]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("dst"))
        e = e.withColumn("place", place).where(F.col("place") <= k).drop("place")
    few = e.groupBy(F.col("src").alias("userid")).agg(F.array_sort(F.collect_list("dst")).alias("f"))
    none = F.expr("cast(array() as array<bigint>)")
    return users_of(adj).join(few, "userid", "left").select("userid", F.coalesce("f", none).alias("ids"))


def listed_pairs(adj: DataFrame) -> DataFrame:
    """Reciprocated pairs ``id1 < id2`` of an adjacency table."""
    return reciprocal_pairs(edges_from_adjacency(adj))


def candidate_blocks(adj: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(id1, id2, l1, l2)``: the canonical key of every listed link, with the one block of each
    member's list that would hold the other member (links without both are not reciprocated)."""
    blocks = list_blocks(adj, block)
    cand = (clean_edges(edges_from_adjacency(adj))
            .select(F.least("src", "dst").alias("id1"), F.greatest("src", "dst").alias("id2")).distinct()
            .withColumn("b1", block_of("id1", block)).withColumn("b2", block_of("id2", block)))
    l1 = blocks.select(F.col("userid").alias("id1"), F.col("blk").alias("b2"), F.col("ids").alias("l1"))
    l2 = blocks.select(F.col("userid").alias("id2"), F.col("blk").alias("b1"), F.col("ids").alias("l2"))
    return cand.join(l1, ["id1", "b2"]).join(l2, ["id2", "b1"]).select("id1", "id2", "l1", "l2")


def common_blocks(adj: DataFrame, pairs: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(id1, id2, l1, l2)``: a row per pair and block that both members have ids in."""
    blocks = list_blocks(adj, block)
    l1 = blocks.select(F.col("userid").alias("id1"), "blk", F.col("ids").alias("l1"))
    l2 = blocks.select(F.col("userid").alias("id2"), "blk", F.col("ids").alias("l2"))
    return pairs.select("id1", "id2").join(l1, "id1").join(l2, ["id2", "blk"]).select("id1", "id2", "l1", "l2")


def union_sizes(adj: DataFrame, pairs: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``(id1, id2, n)``, the number of distinct ids that either member lists."""
    blocks = list_blocks(adj, block)
    sides = [pairs.select("id1", "id2").join(blocks.withColumnRenamed("userid", c), c).select("id1", "id2", "blk", "ids")
             for c in ("id1", "id2")]
    both = sides[0].union(sides[1]).groupBy("id1", "id2", "blk").agg(  # two lists of a block at most
        F.size(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("k"))
    return both.groupBy("id1", "id2").agg(F.sum("k").cast("bigint").alias("n"))


def sum_by_pair(per_block: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """Per-block counts added up per pair; pairs without a common block get 0."""
    sums = per_block.groupBy("id1", "id2").agg(F.sum(column).cast("bigint").alias("n"))
    return pairs.join(sums, ["id1", "id2"], "left").select(
        "id1", "id2", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def bitmap_blocks(edges: DataFrame) -> DataFrame:
    """``(userid, blk, mask, words)`` of edges ``(src, dst)``: the distinct ids of a user in a block of 4,096
    (the user's own left out) as a compressed bitmap: ``mask`` tells which of the block's 64 words hold ids, ``words`` has
    those, in order. At most 520 bytes a row, and an eighth of a byte an id where a list is dense.
    Repeated ids need no distinct: bits are combined in each task before the shuffle."""
    words = proper_edges(edges).groupBy(F.col("src").alias("userid"), F.shiftright("dst", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(dst & 63 as int)))").alias("bits"))
    rows = words.groupBy("userid", F.shiftright("word", 6).alias("blk")).agg(
        F.expr("bit_or(shiftleft(1L, cast(word & 63 as int)))").alias("mask"),
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))  # 64 words at most
    return rows.select("userid", "blk", "mask", F.col("w.bits").alias("words"))


def _word(mask: str, words: str) -> str:
    """The word ``i`` of a bitmap that has it; its place: how many of the mask's bits are below its own."""
    return f"element_at({words}, cast(bit_count({mask} & ~shiftleft(-1L, i)) as int) + 1)"


def _words_in(mask: str) -> str:
    return f"filter(sequence(0, 63), i -> getbit({mask}, i) = 1)"


def bits_in_common(mask1: str, words1: str, mask2: str, words2: str) -> Column:
    """How many ids two bitmaps of one block share: only words that both have are looked at."""
    both = _words_in(f"{mask1} & {mask2}")
    return F.expr(f"aggregate({both}, 0, (n, i) -> n + bit_count({_word(mask1, words1)} & {_word(mask2, words2)}))")


def _turn(rows: DataFrame, column: str, at: int, rounds: int) -> DataFrame:
    """The rows of round ``at`` by their id."""
    return rows if rounds == 1 else rows.where(F.pmod(F.xxhash64(column, F.lit(rounds)), F.lit(rounds)) == at)


def _met(sized: DataFrame, blocks: DataFrame, at: int, rounds: int) -> DataFrame:
    """``(id1, id2, k)``: the ids shared in each block whose masks meet, of the pairs of round ``at``."""
    mine = blocks.select(F.col("userid").alias("s"), "blk", F.col("mask").alias("m1"), F.col("words").alias("w1"))
    sized, mine = _turn(sized, "s", at, rounds), _turn(mine, "s", at, rounds)
    other = blocks.select(F.col("userid").alias("o"), "blk", F.col("mask").alias("m2"), F.col("words").alias("w2"))
    met = sized.join(mine.drop("w1"), "s").join(other, ["o", "blk"]).where("(m1 & m2) <> 0")
    met = met.withColumn("both", F.expr("m1 & m2")).select(  # no other words are sent on
        "few", "s", "o", "blk", "both", F.expr(f"transform({_words_in('both')}, i -> {_word('m2', 'w2')})").alias("w2"))
    return met.join(mine, ["s", "blk"]).select(
        F.when(F.col("few"), F.col("s")).otherwise(F.col("o")).alias("id1"),
        F.when(F.col("few"), F.col("o")).otherwise(F.col("s")).alias("id2"),
        bits_in_common("m1", "w1", "both", "w2").alias("k"))


def shared_by_bitmaps(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """A2 / X8 on dense lists: ``(id1, id2, n)``, the ids on both members' lists, zeros kept.

    A pair is expanded to the blocks of the member that has fewer, and these meet the other's by
    (user, block): work is the smaller number of blocks, so a hub's list is copied to no short one. Only
    masks are sent to that meeting; words go to the pairs whose masks have one in common, and of the other's words
    only those. Pairs and blocks are written once, as both are read more than once. Of many pairs (``ROUND_ROWS``) the blocks
    are made in ``BLOCK_ROUNDS`` rounds by a hash of the user. Where the masks to send are more than that, twice the
    blocks and half the pairs, the pairs are taken in rounds by a hash of the member with fewer blocks, each of which
    writes its counts. The shuffle files of a round go when it ends."""
    with shuffles_dropped(edges.sparkSession):  # each job writes its result
        pairs, asked = materialize(pairs.select("id1", "id2"), "asked_pairs", {"n": F.count(F.lit(1))})
        blocks, kept, turns = None, 0, BLOCK_ROUNDS if asked["n"] > ROUND_ROWS else 1
        for at in range(turns):
            made, n = materialize(bitmap_blocks(_turn(edges, "src", at, turns)), "bitmap_blocks", {"n": F.count(F.lit(1))})
            blocks, kept = made if blocks is None else blocks.unionByName(made), kept + n["n"]
        sizes = blocks.groupBy("userid").agg(F.count(F.lit(1)).alias("b"))
        sized = pairs
        for c in ("1", "2"):
            sized = sized.join(sizes.select(F.col("userid").alias(f"id{c}"), F.col("b").alias(f"b{c}")), f"id{c}")
        few, own = F.col("b1") <= F.col("b2"), Scratch()
        sized, sent = materialize(sized.select(
            few.alias("few"), F.when(few, F.col("id1")).otherwise(F.col("id2")).alias("s"),
            F.when(few, F.col("id2")).otherwise(F.col("id1")).alias("o"), F.least("b1", "b2").alias("b")),
            "sized_pairs", {"n": F.sum("b")}, scope=own)
        sized = sized.drop("b")
        rounds = -(-(sent["n"] or 0) // max(ROUND_ROWS, 2 * kept, asked["n"] // 2))
        if rounds > 1:
            met = None
            for at in range(rounds):
                counts = _met(sized, blocks, at, rounds).groupBy("id1", "id2").agg(F.sum("k").alias("k")).where("k > 0")
                counts = materialize(counts, "shared")
                met = counts if met is None else met.unionByName(counts)
            own.release(edges.sparkSession)
            return sum_by_pair(met, pairs, "k")
    current_scope().folders += own.folders
    return sum_by_pair(_met(sized, blocks, 0, 1), pairs, "k")
