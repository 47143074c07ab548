"""Shared-neighbour count for every reciprocated pair.

For ``a < b`` with ``b`` on a's list and ``a`` on b's list:
``n(a, b) = |(N(a) ∩ N(b)) minus {a, b}|``, kept when ``n > 0``. A shared id need not list ``a`` or
``b`` back, so this is not triangle counting on the reciprocated graph.

``prepare_graph`` writes what both ways of counting read: the reciprocated pairs with the degrees of
their ends, and the edges whose source is in such a pair (no other edge can matter), bucketed by both
ends. Degrees are a small written table that is joined to the *pairs*, so a hub's pairs lie on a plain exchange, which
AQE splits; the edges themselves are never joined to an aggregate.

Two exact ways, routed per pair by the degrees of its two ends:

* **arrays** (both ends have at most ``hub_degree`` ids, and of like number): each end's id set
  is gathered once, joined to its pairs and intersected in generated code. Moves
  ``deg(a) + deg(b)`` ids per pair, in compact arrays of about ``hub_degree`` ids at most: where the
  way is forced on longer lists, they are cut into parts by a hash of the id and counted by part.
* **probe** (an end above ``hub_degree``, or lists of very unequal length): the list of the
  *smaller* end is expanded to rows and each row is checked against the other end's edges with an
  equi semi-join on ``(other, id)``. Moves ``min(deg(a), deg(b))`` rows per pair, whatever the
  hub's size, and never gathers a hub's list.

Where every edge of the pair members is reciprocated (the graph is *closed*), a shared neighbour makes a
triangle of three pairs, and each triangle is looked for once instead of three times: the ends of a pair
are put in order by degree, then id, and a member keeps the list of its *higher* neighbours only. With m
pairs such a list holds at most ``sqrt(2 m)`` ids, a hub's few or none. The ways are the same on these lists:

* **arrays** (the lower end has at most ``hub_degree`` higher neighbours): what follows the other end in
  the list goes to that end as one array, if it has higher neighbours itself, and is intersected
  with them; where the way is forced on longer lists, arrays are cut at ``hub_degree`` ids.
* **probe** (longer lists): two higher neighbours a row, checked against the edges.

Each triangle found adds one to its three pairs. What is sent for that can be many times the edges, so
where it is much the middle vertices ``v`` are taken in rounds by a hash (``_closed_counts``): a round sends about ``ROUND_IDS``
ids for each pair, adds its triangles to the counts of the rounds before, and its shuffle files go when it ends.
A single ``v`` is sent at most the ids of all edges: the higher neighbours of ``v`` are few if its degree is large.

The routed union equals either way alone (tests check all three). No step is a Cartesian or
nested-loop join, and no step emits all pairs within a group of unbounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, materialize, shuffles_dropped, size_setting, write_buckets
from .edges import directed, distinct_links, out_degrees
from .member_filter import build, maybe

# Largest list length gathered into one array. Above it a pair goes to the probe way.
DEFAULT_HUB_DEGREE = 256
# Arrays move deg(a) + deg(b) ids per pair, the probe min(deg) rows (a row costs several ids), so
# lists of very unequal length go the probe way too.
DEFAULT_BALANCE = 4.0
STRATEGIES = ("auto", "arrays", "probe")
# Ids that a round on a closed graph sends for each pair; so many in all need no rounds.
ROUND_IDS = 2
ONE_ROUND = 1 << 25
MANY_LINKS = 1 << 22  # beyond, member edges and pairs are written in so many rounds:
LINK_ROUNDS = 4
WEDGE_IDS = 4  # a row of the probe way counts as so many ids of an array


@dataclass
class Graph:
    """A prepared graph: ``edges(src, dst)``, distinct, sources in some pair only;
    ``pairs(id1, id2, deg1, deg2)``; the largest degree of a pair member; the folders of both
    tables, which ``release`` deletes. Of a closed graph also ``higher(u, d)``, the number of higher
    neighbours of those who have some, their count, the largest ``d``, how many pairs of ids their lists
    hold and a Bloom filter of them."""
    edges: DataFrame
    pairs: DataFrame
    largest: int
    scratch: Scratch
    size: int = 0  # pairs
    higher: DataFrame | None = None
    sources: int = 0
    longest: int = 0
    wedges: int = 0
    source_bits: DataFrame | None = None

    def release(self, spark: SparkSession) -> int:
        return self.scratch.release(spark)


def prepare_graph(edges: DataFrame) -> Graph:
    """Run the jobs that every count over a directed edge table ``(src, dst)`` shares.

    The edge source is scanned (and text parsed) once: its distinct links are written, the pairs are those
    that go both ways, and the edges of their members come from the written links. Members that are
    too many to broadcast are told by a Bloom filter in that scan, so that other edges are not
    shuffled. The member edges are dealt by both ends: an exchange of their own, so AQE may split a
    hub in the semi-join before it on any session, and the buckets they are written in, which the
    probe reads without another one.
    """
    held, used, spark = Scratch(), Scratch(), edges.sparkSession
    with shuffles_dropped(spark):  # each job writes its result
        return _prepare(edges, held, used, spark)


def _prepare(edges: DataFrame, held: Scratch, used: Scratch, spark: SparkSession) -> Graph:
    links, size = materialize(distinct_links(edges), "links", {"n": F.count(F.lit(1))}, scope=used)
    turns = LINK_ROUNDS if size["n"] > MANY_LINKS else 1
    met = links.where("up and down").select("id1", "id2")
    members, many = materialize(met.select(F.explode(F.array("id1", "id2")).alias("src")).distinct(), "members",
                                {"n": F.count(F.lit(1))}, scope=used)
    n = many["n"] or 0
    bits = None if _broadcastable(spark, n) else build(members, "src", n, scope=used)

    def of_members(at):
        return maybe(directed(_round(links, at, turns)), "src", bits, n).join(members, "src", "left_semi")
    own = write_buckets(of_members(0), "member_edges", ["src", "dst"], held, [of_members(at) for at in range(1, turns)])
    degrees, seen = materialize(out_degrees(own), "degrees", {"top": F.max("deg"), "n": F.sum("deg")}, scope=used)
    pairs, both = None, {"n": 0}
    for at in range(turns):
        some = _round(met, at, turns).join(degrees.select(F.col("src").alias("id1"), F.col("deg").alias("deg1")), "id1").join(
            degrees.select(F.col("src").alias("id2"), F.col("deg").alias("deg2")), "id2")
        some, more = materialize(some.select("id1", "id2", "deg1", "deg2"), "pairs", {"n": F.count(F.lit(1))}, scope=held)
        pairs, both["n"] = some if pairs is None else pairs.unionByName(some), both["n"] + (more["n"] or 0)
    used.release(spark)  # read no more
    graph = Graph(own, pairs, int(seen["top"] or 0), held)
    graph.size = both["n"]
    if both["n"] and seen["n"] == 2 * both["n"]:  # no member edge goes one way
        higher = _ordered(pairs).groupBy("u").agg(F.count(F.lit(1)).alias("d"))
        graph.higher, few = materialize(higher, "higher", {
            "n": F.count(F.lit(1)), "top": F.max("d"), "wedges": F.sum(_pairs_in("d"))}, scope=held)
        graph.sources, graph.longest, graph.wedges = few["n"], few["top"], few["wedges"]
        graph.source_bits = build(graph.higher.select("u"), "u", few["n"], scope=held)
    return graph


def _round(links: DataFrame, at: int, rounds: int) -> DataFrame:
    """The links of round ``at``, by a hash of both ends."""
    return links if rounds == 1 else links.where(F.pmod(F.xxhash64("id1", "id2", F.lit(rounds)), F.lit(rounds)) == at)


def _pairs_in(d: str) -> Column:
    """How many pairs ``d`` ids make."""
    return F.expr(f"{d} * ({d} - 1) div 2")


def _broadcastable(spark: SparkSession, ids: int) -> bool:
    """Whether the session would broadcast a table of so many ids (about 16 bytes each)."""
    return 16 * ids <= size_setting(spark, "spark.sql.autoBroadcastJoinThreshold")


def _by_arrays(edges: DataFrame, pairs: DataFrame, parts: int) -> DataFrame:
    """Lists gathered in ``parts`` parts by a hash of the id; counts added up per pair."""
    part = F.pmod(F.xxhash64("dst"), F.lit(parts)).cast("int") if parts > 1 else F.lit(0)
    members = pairs.select(F.explode(F.array("id1", "id2")).alias("src"))
    nbrs = (edges.join(members, "src", "left_semi").groupBy("src", part.alias("part"))
            .agg(F.collect_list("dst").alias("nbrs")))  # rows already distinct
    n1 = nbrs.select(F.col("src").alias("id1"), "part", F.col("nbrs").alias("n1"))
    n2 = nbrs.select(F.col("src").alias("id2"), "part", F.col("nbrs").alias("n2"))
    # Self-listings are gone, so neither a nor b can be in both sets: no exclusion needed.
    met = pairs.select("id1", "id2").join(n1, "id1").join(n2, ["id2", "part"])
    counts = met.select("id1", "id2", F.size(F.array_intersect("n1", "n2")).cast("bigint").alias("n"))
    return counts if parts == 1 else counts.groupBy("id1", "id2").agg(F.sum("n").alias("n"))


def _by_probe(e: DataFrame, pairs: DataFrame) -> DataFrame:
    small_first = F.col("deg1") <= F.col("deg2")
    # The pair is (least, greatest) of its two ends, so rows carry only (s, o, c).
    sides = pairs.select(
        F.when(small_first, F.col("id1")).otherwise(F.col("id2")).alias("s"),
        F.when(small_first, F.col("id2")).otherwise(F.col("id1")).alias("o"))
    expanded = sides.join(e.select(F.col("src").alias("s"), F.col("dst").alias("c")), "s")
    other = e.select(F.col("src").alias("o"), F.col("dst").alias("c"))
    hits = expanded.join(other, ["o", "c"], "left_semi")
    return (hits.groupBy("s", "o").agg(F.count(F.lit(1)).alias("n"))
            .select(F.least("s", "o").alias("id1"), F.greatest("s", "o").alias("id2"), "n"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """``(u, v, at)``: each pair with the end of smaller (degree, id) first; ``at`` is the degree of ``v``."""
    up = (F.col("deg1") < F.col("deg2")) | ((F.col("deg1") == F.col("deg2")) & (F.col("id1") < F.col("id2")))
    return pairs.select(F.when(up, F.col("id1")).otherwise(F.col("id2")).alias("u"),
                        F.when(up, F.col("id2")).otherwise(F.col("id1")).alias("v"),
                        F.when(up, F.col("deg2")).otherwise(F.col("deg1")).alias("at"))


def _lists(g: Graph) -> DataFrame:
    """``(u, l)``: the higher neighbours of each who has some, in order."""
    return (_ordered(g.pairs).groupBy("u").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("l"))
            .select("u", F.col("l.v").alias("l")))


def _slice(rows: DataFrame, column: str, turn: tuple[int, int]) -> DataFrame:
    """The rows of one round ``(number, of how many)`` by their id."""
    at, rounds = turn
    return rows if rounds == 1 else rows.where(F.pmod(F.xxhash64(column, F.lit(rounds)), F.lit(rounds)) == at)


def _tails(g: Graph, lists: DataFrame, longest: int, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """``(u, l, i, v)``: the places ``i`` of the lists of at most ``longest`` ids whose ``v`` (of this round) has
    higher neighbours, maybe, and an id after it."""
    tails = (lists.where((F.size("l") > 1) & (F.size("l") <= longest)).select("u", "l", F.posexplode("l").alias("i", "v"))
             .where(F.col("i") < F.size("l") - 1))
    return maybe(_slice(tails, "v", turn), "v", g.source_bits, g.sources)


def _triangles_by_arrays(g: Graph, longest: int, cut: int, lists: DataFrame | None = None,
                         turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """Triangles ``(u, v, w)`` of a closed graph whose ``u`` has at most ``longest`` higher neighbours;
    no array that is sent on or met holds more than ``cut`` ids. ``turn``: only those with ``v`` of that round."""
    lists = _lists(g) if lists is None else lists
    tails = _tails(g, lists, longest, turn)
    tails = tails.select("u", "v", F.slice("l", F.col("i") + 2, F.size("l")).alias("l"))
    theirs = _slice(lists.select(F.col("u").alias("v"), F.col("l").alias("other")), "v", turn)
    if g.longest > cut:
        tails, theirs = _cut(tails, "l", cut), _cut(theirs, "other", cut)
    # A row of few kB for each id at most: hashed, so that the tails need no sort.
    met = tails.join(theirs.hint("shuffle_hash"), "v")
    return met.select("u", "v", F.explode(F.array_intersect("l", "other")).alias("w"))


def _cut(rows: DataFrame, column: str, size: int) -> DataFrame:
    """Rows with the array in pieces of at most ``size``."""
    at = F.explode(F.expr(f"sequence(1, size({column}), {int(size)})")).alias("_at")
    return rows.select("*", at).withColumn(column, F.slice(column, F.col("_at"), F.lit(int(size)))).drop("_at")


def _triangles_by_probe(g: Graph, beyond: int, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """Triangles ``(u, v, w)`` of a closed graph whose ``u`` has more than ``beyond`` higher neighbours
    (``turn``: with ``v`` of that round)."""
    up = _ordered(g.pairs)
    if beyond > 0:
        up = up.join(g.higher.where(F.col("d") > beyond).select("u"), "u", "left_semi")
    a = maybe(_slice(up, "v", turn), "v", g.source_bits, g.sources)
    b = up.select("u", F.col("v").alias("w"), F.col("at").alias("above"))
    follows = (F.col("at") < F.col("above")) | ((F.col("at") == F.col("above")) & (F.col("v") < F.col("w")))
    wedges = a.join(b, "u").where(follows).select("u", "v", "w")
    return wedges.join(g.edges.select(F.col("src").alias("v"), F.col("dst").alias("w")), ["v", "w"], "left_semi")


def _per_pair(found: DataFrame) -> DataFrame:
    """``(id1, id2)``: the three pairs of each triangle."""
    of = [F.struct(F.least(a, b).alias("id1"), F.greatest(a, b).alias("id2")) for a, b in ("uv", "uw", "vw")]
    return found.select(F.explode(F.array(*of)).alias("p")).select("p.id1", "p.id2")


def _closed_counts(g: Graph, strategy: str, hub_degree: int) -> DataFrame:
    """Counts of a closed graph: one for each pair of each triangle. Where more than ``ONE_ROUND`` ids may be sent this
    runs jobs: the lists of higher neighbours are written once, and the triangles are found in rounds."""
    longest = {"arrays": g.longest, "probe": 0}.get(strategy, hub_degree)  # of the lists that go the arrays way

    def pairs_of(lists=None, turn=(0, 1)):
        ways = []
        if strategy != "probe":
            ways.append(_triangles_by_arrays(g, longest, hub_degree, lists, turn))
        if strategy != "arrays":
            ways.append(_triangles_by_probe(g, longest, turn))
        found = ways[0] if len(ways) == 1 else ways[0].unionByName(ways[1])
        of = [F.struct(F.least(a, b).alias("id1"), F.greatest(a, b).alias("id2")) for a, b in ("uv", "uw", "vw")]
        return found.select(F.explode(F.array(*of)).alias("p")).select("p.id1", "p.id2")

    if WEDGE_IDS * g.wedges <= ONE_ROUND:
        return pairs_of().groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("n"))
    spark, written, counts, last = g.pairs.sparkSession, Scratch(), None, Scratch()
    with shuffles_dropped(spark):
        lists = None if strategy == "probe" else materialize(_lists(g), "lists", scope=written)
        sent = WEDGE_IDS * (g.higher.where(F.col("d") > longest).agg(F.sum(_pairs_in("d"))).first()[0] or 0)
        if lists is not None:
            sent += _tails(g, lists, longest).agg(F.sum(F.size("l") - 1 - F.col("i"))).first()[0] or 0
        turns = -(-sent // max(ONE_ROUND, ROUND_IDS * g.size))
        for at in range(turns if turns > 1 else 0):
            rows = pairs_of(lists, (at, turns)).withColumn("n", F.lit(1).cast("bigint"))
            rows, before = rows if counts is None else rows.unionByName(counts), last
            last = Scratch()
            counts = materialize(rows.groupBy("id1", "id2").agg(F.sum("n").alias("n")), "counts", scope=last)
            before.release(spark)
    if counts is None:  # the plan reads the lists
        g.scratch.folders += written.folders
        return pairs_of(lists).groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("n"))
    written.release(spark)
    g.scratch.folders += last.folders
    return counts


def mutual_counts(graph: Graph | DataFrame, strategy: str = "auto", hub_degree: int = DEFAULT_HUB_DEGREE,
                  balance: float = DEFAULT_BALANCE, keep_zero: bool = False) -> DataFrame:
    """``(id1, id2, n)`` for the reciprocated pairs of a prepared graph, a lazy plan.

    A directed edge table ``(src, dst)`` is prepared first, which runs jobs (``prepare_graph``).
    So does a closed graph on which much is sent (``_closed_counts``).
    ``strategy``: ``auto`` sends a pair the arrays way when both lists are short
    (``max(deg) <= hub_degree``) and of like size (``max(deg) <= balance * min(deg)``), else the
    probe way; ``arrays`` / ``probe`` force one way. Both are always planned under ``auto``; a way
    without pairs reads nothing but the pairs table. On a closed graph the arrays way takes the lists
    of at most ``hub_degree`` higher neighbours, the probe way the rest; ``balance`` plays no part.
    ``keep_zero`` keeps pairs that share nobody (``n = 0``); the default drops them (F1).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    g = graph if isinstance(graph, Graph) else prepare_graph(graph)
    hi, lo = F.greatest("deg1", "deg2"), F.least("deg1", "deg2")
    light = (hi <= hub_degree) & (hi <= lo * balance)
    if g.higher is not None:
        counts = _closed_counts(g, strategy, hub_degree)
    elif strategy == "arrays":
        counts = _by_arrays(g.edges, g.pairs, max(1, -(-g.largest // hub_degree)))
    elif strategy == "probe":
        counts = _by_probe(g.edges, g.pairs)
    else:
        counts = _by_arrays(g.edges, g.pairs.where(light), 1).unionByName(_by_probe(g.edges, g.pairs.where(~light)))
    if keep_zero:
        return (g.pairs.select("id1", "id2").join(counts, ["id1", "id2"], "left")
                .select("id1", "id2", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
    return counts.where(F.col("n") > 0).select("id1", "id2", F.col("n").cast("bigint").alias("n"))
