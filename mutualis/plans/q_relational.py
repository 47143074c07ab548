"""One query per relational operator on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import canonical_pair, is_reciprocal
from ..operators import (
    clean_edges, edges_from_adjacency, lists, mean_ratings, mutual_counts, of_top_keys, pair_members,
    ratings_for, reciprocal_pairs, reciprocal_pairs_by_self_join, sort_desc, top_k, top_pairs,
)
from ..sources import tables
from . import sql as S
from .catalog import adjacency, graph, query
from .q_jobs import PATTERN, q1_counts

_TOP_PAIRS = "t AS (SELECT id1, id2, n FROM c ORDER BY n DESC, id1, id2 LIMIT 10)"

# ---------------- projections ----------------


@query("proj_map_rows", f"WITH r AS ({S.REVIEWS}) SELECT businessid, userid, stars FROM r")
def proj_map_rows(spark, sf_dir):
    return tables.reviews(spark, sf_dir).select("businessid", "userid", "stars")


@query("proj_explode_edges", "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem")
def proj_explode_edges(spark, sf_dir):
    """Parsed adjacency lines → one row per listed id (self-listings kept)."""
    return edges_from_adjacency(adjacency(spark, sf_dir))


@query("proj_select_alias", """
SELECT p_partkey AS userid, p_name AS firstname, p_brand AS lastname, p_type AS address FROM part""")
def proj_select_alias(spark, sf_dir):
    p = tables.table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("userid"), F.col("p_name").alias("firstname"),
                    F.col("p_brand").alias("lastname"), F.col("p_type").alias("address"))


@query("proj_with_column", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity,
       CAST(l_quantity AS BIGINT) * 2 AS double_qty FROM lineitem""")
def proj_with_column(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return (li.withColumn("l_quantity", F.col("l_quantity").cast("bigint"))
            .withColumn("double_qty", F.col("l_quantity") * 2))


@query("proj_rename", f"WITH e AS ({S.EDGES}) SELECT src AS id1, dst AS id2 FROM e")
def proj_rename(spark, sf_dir):
    e = clean_edges(tables.supplies(spark, sf_dir))
    return e.withColumnRenamed("src", "id1").withColumnRenamed("dst", "id2")


@query("proj_drop", f"WITH r AS ({S.REVIEWS}) SELECT userid, businessid, stars FROM r")
def proj_drop(spark, sf_dir):
    r = tables.reviews(spark, sf_dir)
    return r.drop(r.reviewid)


@query("proj_table_alias", """
SELECT l.l_orderkey, l.l_linenumber, p.p_name FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def proj_table_alias(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem").alias("l")
    p = tables.table(spark, sf_dir, "part").alias("p")
    return (li.join(p, F.col("l.l_partkey") == F.col("p.p_partkey"))
            .select(F.col("l.l_orderkey"), F.col("l.l_linenumber"), F.col("p.p_name")))


@query("proj_literal", "SELECT p_partkey AS userid, CAST(0 AS INTEGER) AS flag FROM part")
def proj_literal(spark, sf_dir):
    p = tables.table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("userid"), F.lit(0).cast("int").alias("flag"))


@query("proj_swap_key", f"""{S.mutual()}
SELECT n AS key, CAST(id1 AS VARCHAR) || ', ' || CAST(id2 AS VARCHAR) AS value FROM c""")
def proj_swap_key(spark, sf_dir):
    """``(pair, n)`` → ``(n, pair)``, the key the count-ranked variant sorts on."""
    c = q1_counts(spark, sf_dir)
    return c.select(F.col("n").alias("key"),
                    F.concat_ws(", ", F.col("id1").cast("string"), F.col("id2").cast("string"))
                    .alias("value"))


@query("pair_canonical_key", f"""WITH s AS ({S.SUPPLIES})
SELECT LEAST(src, dst) AS id1, GREATEST(src, dst) AS id2 FROM s""")
def pair_canonical_key(spark, sf_dir):
    lo, hi = canonical_pair("src", "dst")
    return tables.supplies(spark, sf_dir).select(lo.alias("id1"), hi.alias("id2"))


# ---------------- filters ----------------


@query("filter_nonzero", f"{S.mutual()} SELECT id1, id2, n FROM c")
def filter_nonzero(spark, sf_dir):
    allp = mutual_counts(graph(spark, sf_dir, "supplies"), keep_zero=True)
    return allp.where("n <> 0")


@query("filter_pair_order", f"WITH s AS ({S.SUPPLIES}) SELECT src AS id1, dst AS id2 FROM s WHERE src < dst")
def filter_pair_order(spark, sf_dir):
    s = tables.supplies(spark, sf_dir)
    return s.where(F.col("src") < F.col("dst")).select(F.col("src").alias("id1"), F.col("dst").alias("id2"))


@query("filter_reciprocal", f"WITH e AS ({S.EDGES}) {S.PAIRS}")
def filter_reciprocal(spark, sf_dir):
    """F3 in its row form: candidate pairs are the distinct canonical keys of the listed links
    (never a Cartesian product); each candidate row carries, for each member, the one block of its
    list that would hold the other member; the two membership tests filter."""
    cand = lists.candidate_blocks(adjacency(spark, sf_dir))
    return cand.where(is_reciprocal("id1", "l1", "id2", "l2")).select("id1", "id2")


@query("filter_reciprocal_narrow", f"WITH e AS ({S.EDGES}) {S.PAIRS}")
def filter_reciprocal_narrow(spark, sf_dir):
    """The same over lists cut into many lines and blocks."""
    cand = lists.candidate_blocks(adjacency(spark, sf_dir, "adjacency_narrow"), 8)
    return cand.where(is_reciprocal("id1", "l1", "id2", "l2")).select("id1", "id2")


@query("filter_contains", f"""WITH b AS ({S.BUSINESSES})
SELECT businessid, address FROM b WHERE contains(address, '{PATTERN}')""")
def filter_contains(spark, sf_dir):
    b = tables.businesses(spark, sf_dir)
    return b.where(F.col("address").contains(PATTERN)).select("businessid", "address")


@query("filter_like", f"SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%{PATTERN}%'")
def filter_like(spark, sf_dir):
    p = tables.table(spark, sf_dir, "part")
    return p.where(F.col("p_name").like(f"%{PATTERN}%")).select("p_partkey", "p_name")


@query("filter_sql_string", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_linenumber <> 1""")
def filter_sql_string(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    return (li.where("l_quantity > 45 and l_linenumber != 1")
            .select("l_orderkey", "l_linenumber", "l_quantity"))


# ---------------- joins ----------------


@query("join_inner", f"""WITH r AS ({S.REVIEWS}), b AS ({S.BUSINESSES})
SELECT r.reviewid, r.userid, r.businessid, b.address FROM r JOIN b ON r.businessid = b.businessid""")
def join_inner(spark, sf_dir):
    r = tables.reviews(spark, sf_dir)
    b = tables.businesses(spark, sf_dir)
    return r.join(b, r.businessid == b.businessid).select(r.reviewid, r.userid, r.businessid, b.address)


@query("join_inner_triple", f"""WITH r AS ({S.REVIEWS}), b AS ({S.BUSINESSES})
SELECT b.businessid, b.address, r.userid, r.stars FROM b JOIN r ON r.businessid = b.businessid
WHERE b.address LIKE '%{PATTERN}%'""")
def join_inner_triple(spark, sf_dir):
    """Keyed join ``(k, v) ⋈ (k, w)`` → ``(k, v, w)``."""
    b = tables.businesses(spark, sf_dir).where(F.col("address").like(f"%{PATTERN}%"))
    r = tables.reviews(spark, sf_dir)
    return b.select("businessid", "address").join(r.select("businessid", "userid", "stars"), "businessid")


@query("join_lookup_broadcast", f"""{S.mutual()}, {_TOP_PAIRS}
SELECT t.id1, t.id2, u.userid, u.p_name AS firstname
FROM t JOIN (SELECT p_partkey AS userid, p_name FROM part) u ON u.userid IN (t.id1, t.id2)""")
def join_lookup_broadcast(spark, sf_dir):
    """A short key list (the top pairs' members, bounded by k) looked up in the profile table;
    the limit tells the planner how short it is."""
    members = pair_members(top_pairs(q1_counts(spark, sf_dir), 10))
    prof = tables.profiles(spark, sf_dir).select("userid", "firstname")
    return prof.join(members, "userid").select("id1", "id2", "userid", "firstname")


@query("join_or_equi", f"""{S.mutual()}
SELECT p.id1, p.id2, u.userid, u.p_name AS firstname
FROM p JOIN (SELECT p_partkey AS userid, p_name FROM part) u ON u.userid = p.id1 OR u.userid = p.id2""")
def join_or_equi(spark, sf_dir):
    """``userid = id1 OR userid = id2`` as one equi-join on the exploded pair members."""
    pairs = reciprocal_pairs(clean_edges(tables.supplies(spark, sf_dir)))
    members = pairs.select("id1", "id2", F.explode(F.array("id1", "id2")).alias("userid"))
    prof = tables.profiles(spark, sf_dir).select("userid", "firstname")
    return members.join(prof, "userid").select("id1", "id2", "userid", "firstname")


@query("join_left_semi", f"""{S.mutual()}
SELECT userid, firstname, lastname, address FROM ({S.PROFILES}) pr
WHERE userid IN (SELECT id1 FROM p UNION SELECT id2 FROM p)""")
def join_left_semi(spark, sf_dir):
    """Profiles that have a match among the members of reciprocated pairs."""
    pairs = reciprocal_pairs(clean_edges(tables.supplies(spark, sf_dir)))
    members = pairs.select(F.explode(F.array("id1", "id2")).alias("userid"))
    prof = tables.profiles(spark, sf_dir).select("userid", "firstname", "lastname", "address")
    return prof.join(members, "userid", "left_semi")


@query("join_self", f"WITH e AS ({S.EDGES}) {S.PAIRS}")
def join_self(spark, sf_dir):
    return reciprocal_pairs_by_self_join(clean_edges(tables.supplies(spark, sf_dir)))


@query("join_meet_on_pair", f"WITH e AS ({S.EDGES}) {S.PAIRS}")
def join_meet_on_pair(spark, sf_dir):
    return reciprocal_pairs(clean_edges(tables.supplies(spark, sf_dir)))


# ---------------- aggregates ----------------


@query("agg_reduce_by_key", f"""WITH r AS ({S.REVIEWS})
SELECT userid, SUM(stars) AS total_stars FROM r GROUP BY userid""")
def agg_reduce_by_key(spark, sf_dir):
    return tables.reviews(spark, sf_dir).groupBy("userid").agg(F.sum("stars").alias("total_stars"))


@query("agg_avg_by_group", f"""WITH r AS ({S.REVIEWS})
SELECT businessid, AVG(stars) AS avg_stars FROM r GROUP BY businessid""")
def agg_avg_by_group(spark, sf_dir):
    return mean_ratings(tables.reviews(spark, sf_dir))


@query("agg_collect_list", f"""{S.mutual()}, {_TOP_PAIRS}
SELECT t.id1, t.id2, t.n, string_agg(u.p_name, '|' ORDER BY u.p_name) AS names
FROM t JOIN part u ON u.p_partkey IN (t.id1, t.id2) GROUP BY t.id1, t.id2, t.n""")
def agg_collect_list(spark, sf_dir):
    """A5 on groups bounded by construction (two members per top pair); sorted so order is fixed."""
    members = pair_members(top_pairs(q1_counts(spark, sf_dir), 10))
    prof = tables.profiles(spark, sf_dir).select("userid", "firstname")
    return (prof.join(members, "userid").groupBy("id1", "id2", "n")
            .agg(F.array_join(F.array_sort(F.collect_list("firstname")), "|").alias("names")))


@query("agg_multi_key", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines, SUM(l_quantity) AS sum_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_multi_key(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"))


@query("agg_distinct_rows", f"WITH r AS ({S.REVIEWS}) SELECT DISTINCT userid, stars FROM r")
def agg_distinct_rows(spark, sf_dir):
    return tables.reviews(spark, sf_dir).select("userid", "stars").distinct()


@query("agg_count_rows", f"""WITH r AS ({S.REVIEWS_DUP})
SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM r) d) AS n_distinct FROM r""")
def agg_count_rows(spark, sf_dir):
    """Rows and distinct rows in one pass: count per distinct line, then sum and count those."""
    r = tables.reviews_dup(spark, sf_dir)
    per_line = r.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("c"))
    return per_line.agg(F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))


@query("agg_sum_count", f"""WITH r AS ({S.REVIEWS})
SELECT businessid, SUM(stars) AS total_stars, COUNT(*) AS n_reviews, SUM(stars) / COUNT(*) AS mean_stars
FROM r GROUP BY businessid""")
def agg_sum_count(spark, sf_dir):
    r = tables.reviews(spark, sf_dir)
    return (r.groupBy("businessid")
            .agg(F.sum("stars").alias("total_stars"), F.count(F.lit(1)).alias("n_reviews"))
            .withColumn("mean_stars", F.col("total_stars") / F.col("n_reviews")))


# ---------------- sorts and top-k ----------------


@query("sort_desc", f"""WITH r AS ({S.REVIEWS})
SELECT businessid, AVG(stars) AS avg_stars FROM r GROUP BY businessid ORDER BY avg_stars DESC, businessid""")
def sort_desc_q(spark, sf_dir):
    return sort_desc(mean_ratings(tables.reviews(spark, sf_dir)), "avg_stars", ["businessid"])


@query("topk_by_value", f"""WITH r AS ({S.REVIEWS})
SELECT businessid, AVG(stars) AS avg_stars FROM r GROUP BY businessid ORDER BY avg_stars DESC, businessid
LIMIT 10""")
def topk_by_value(spark, sf_dir):
    return top_k(mean_ratings(tables.reviews(spark, sf_dir)), 10, [F.col("avg_stars").desc()], ["businessid"])


@query("topk_by_key", f"""WITH r AS ({S.REVIEWS})
SELECT businessid, AVG(stars) AS avg_stars FROM r GROUP BY businessid ORDER BY businessid DESC LIMIT 10""")
def topk_by_key(spark, sf_dir):
    return mean_ratings(of_top_keys(tables.reviews(spark, sf_dir), "businessid", 10))


@query("topk_pairs", f"{S.mutual()} SELECT id1, id2, n FROM c ORDER BY n DESC, id1, id2 LIMIT 10")
def topk_pairs(spark, sf_dir):
    return top_pairs(q1_counts(spark, sf_dir), 10)


@query("q3_filter_then_join", f"""WITH b AS ({S.BUSINESSES}), r AS ({S.REVIEWS})
SELECT userid, stars FROM (
  SELECT DISTINCT r.businessid, r.userid, r.stars FROM r JOIN b ON b.businessid = r.businessid
  WHERE contains(b.address, '{PATTERN}')) d""")
def q3_filter_then_join(spark, sf_dir):
    """C4 with the substring test (F4) in place of LIKE: same rows when the text has no wildcard."""
    return ratings_for(tables.businesses(spark, sf_dir), tables.reviews(spark, sf_dir), PATTERN,
                       per_business=True, match="contains")
