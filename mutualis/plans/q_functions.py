"""Scalar, array and string functions, and the UDF surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shared_count, tab_line
from ..functions.udfs import reciprocal_udf, shared_count_udf, tab_line_udf, to_float_udf
from ..operators import clean_edges, edges_from_adjacency, lists, mean_ratings, ratings_for, reciprocal_pairs
from ..sources import tables, text
from . import sql as S
from .catalog import adjacency, ids_text, lines, query
from .q_jobs import PATTERN

_ADJ = f"WITH a AS ({S.ADJACENCY})"


# Shared ids for every reciprocated pair, zeros included.
_ALL_COUNTS = f"""{S.mutual()}
SELECT p.id1, p.id2, COALESCE(c.n, 0) AS n FROM p LEFT JOIN c ON c.id1 = p.id1 AND c.id2 = p.id2"""


@query("str_split", """
SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words,
       string_split(p_name, ' ')[1] AS first_word FROM part""")
def str_split(spark, sf_dir):
    p = tables.table(spark, sf_dir, "part")
    words = text.split_fields(F.col("p_name"), " ")
    return p.select("p_partkey", F.size(words).cast("bigint").alias("n_words"),
                    F.get(words, 0).alias("first_word"))


@query("str_replace", f"""WITH e AS ({S.EDGES})
SELECT replace(replace('(' || CAST(src AS VARCHAR) || ', ' || CAST(dst AS VARCHAR) || ')', '(', ''), ')', '')
       AS pair_key FROM e""")
def str_replace(spark, sf_dir):
    """Tuple text ``(a, b)`` → ``a, b`` by removing the brackets."""
    e = clean_edges(tables.supplies(spark, sf_dir))
    tup = F.concat(F.lit("("), F.col("src").cast("string"), F.lit(", "), F.col("dst").cast("string"),
                   F.lit(")"))
    return e.select(F.replace(F.replace(tup, F.lit("("), F.lit("")), F.lit(")"), F.lit("")).alias("pair_key"))


@query("str_concat", f"""WITH r AS ({S.REVIEWS})
SELECT reviewid, userid || chr(9) || CAST(stars AS VARCHAR) AS value FROM r""")
def str_concat(spark, sf_dir):
    r = tables.reviews(spark, sf_dir)
    return r.select("reviewid", F.concat("userid", F.lit("\t"), F.col("stars").cast("string")).alias("value"))


@query("cast_int", """
SELECT CAST(l_orderkey AS BIGINT) AS orderkey, CAST(l_linenumber AS BIGINT) AS linenumber,
       CAST(l_partkey AS BIGINT) AS partkey FROM lineitem""")
def cast_int(spark, sf_dir):
    """Ids parsed back from review text (``order-line`` id and business id)."""
    r = text.parse_reviews(lines(spark, sf_dir, "reviews"))
    parts = text.split_fields(F.col("reviewid"), "-")
    return r.select(F.get(parts, 0).cast("bigint").alias("orderkey"),
                    F.get(parts, 1).cast("bigint").alias("linenumber"),
                    F.col("businessid").cast("bigint").alias("partkey"))


@query("cast_float", """
SELECT p_partkey, CAST(CAST(p_size AS VARCHAR) AS DOUBLE) AS size_d,
       TRY_CAST(p_name AS DOUBLE) AS name_d FROM part""")
def cast_float(spark, sf_dir):
    """Text → double, strict for well-formed text and ``try_cast`` (null) for the rest."""
    p = tables.table(spark, sf_dir, "part")
    return p.select("p_partkey", F.col("p_size").cast("string").cast("double").alias("size_d"),
                    F.col("p_name").try_cast("double").alias("name_d"))


@query("array_get", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS w0, string_split(p_name, ' ')[2] AS w1,
       string_split(p_name, ' ')[3] AS w2 FROM part""")
def array_get(spark, sf_dir):
    """P10: element by position; past the end gives null (``c[i]`` would fail under ANSI)."""
    p = tables.table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select("p_partkey", F.get(words, 0).alias("w0"), F.get(words, 1).alias("w1"),
                    F.get(words, 2).alias("w2"))


@query("array_drop_blank", """
SELECT p_partkey AS userid, CAST(p_size AS VARCHAR) || ',' || CAST(p_partkey AS VARCHAR) AS ids,
       CAST(2 AS BIGINT) AS n_ids FROM part""")
def array_drop_blank(spark, sf_dir):
    """``size,,id,`` (blank tokens) → ``[size, id]``."""
    p = tables.table(spark, sf_dir, "part")
    raw = F.concat(F.col("p_size").cast("string"), F.lit(",,"), F.col("p_partkey").cast("string"), F.lit(","))
    ids = text.id_list(raw)
    return p.select(F.col("p_partkey").alias("userid"), ids_text(ids).alias("ids"),
                    F.size(ids).cast("bigint").alias("n_ids"))


@query("array_contains", f"""{_ADJ}
SELECT a.userid, list_contains(a.friend_list, CAST(p.p_size AS BIGINT)) AS lists_size
FROM a JOIN part p ON p.p_partkey = a.userid""")
def array_contains(spark, sf_dir):
    """Does a part's supplier list hold the id equal to its size."""
    asked = tables.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("userid"), F.col("p_size").cast("bigint").alias("id"))
    return lists.lists_contain(adjacency(spark, sf_dir), asked).select("userid", F.col("found").alias("lists_size"))


_UNION_SIZES = f"""{S.mutual()}, a AS ({S.ADJACENCY})
SELECT p.id1, p.id2, CAST(len(list_distinct(list_concat(x.friend_list, y.friend_list))) AS BIGINT) AS n_union
FROM p JOIN a x ON x.userid = p.id1 JOIN a y ON y.userid = p.id2"""


@query("array_distinct", _UNION_SIZES)
def array_distinct(spark, sf_dir):
    """List → set; here the number of ids that either member of a pair lists."""
    adj = adjacency(spark, sf_dir)
    return lists.union_sizes(adj, lists.listed_pairs(adj)).withColumnRenamed("n", "n_union")


@query("array_distinct_narrow", _UNION_SIZES)
def array_distinct_narrow(spark, sf_dir):
    """The same over lists cut into many lines and blocks."""
    adj = adjacency(spark, sf_dir, "adjacency_narrow")
    return lists.union_sizes(adj, lists.listed_pairs(adj), 8).withColumnRenamed("n", "n_union")


@query("array_size", f"{_ADJ} SELECT userid, CAST(len(friend_list) AS BIGINT) AS n_friends FROM a")
def array_size(spark, sf_dir):
    return lists.list_sizes(adjacency(spark, sf_dir)).withColumnRenamed("n", "n_friends")


@query("array_remove", f"""{_ADJ}
SELECT userid, COALESCE((SELECT string_agg(CAST(x AS VARCHAR), ',' ORDER BY x)
                         FROM unnest(friend_list) AS t(x) WHERE x <> userid), '') AS ids FROM a""")
def array_remove(spark, sf_dir):
    """A user's own id taken off its list (every occurrence)."""
    return lists.whole_lists(adjacency(spark, sf_dir)).select(
        "userid", ids_text(F.array_remove("friend_list", F.col("userid"))).alias("ids"))


@query("array_append", f"""{_ADJ}
SELECT userid, CAST(len(friend_list) + 1 AS BIGINT) AS n_ids,
       array_to_string(list_append(friend_list, userid), ',') AS ids FROM a""")
def array_append(spark, sf_dir):
    appended = F.array_append("friend_list", F.col("userid"))
    return lists.whole_lists(adjacency(spark, sf_dir)).select(
        "userid", F.size(appended).cast("bigint").alias("n_ids"), ids_text(appended).alias("ids"))


_FIRST3 = f"""{_ADJ}
SELECT userid, array_to_string(list_slice(friend_list, 1, 3), ',') AS first3 FROM a"""


@query("array_slice", _FIRST3)
def array_slice(spark, sf_dir):
    return lists.first_ids(adjacency(spark, sf_dir), 3).select("userid", ids_text("ids").alias("first3"))


@query("array_slice_narrow", _FIRST3)
def array_slice_narrow(spark, sf_dir):
    """The same over lists cut into many lines and blocks."""
    firsts = lists.first_ids(adjacency(spark, sf_dir, "adjacency_narrow"), 3, 8)
    return firsts.select("userid", ids_text("ids").alias("first3"))


@query("array_build", f"""{S.mutual()}
SELECT id1, id2, CAST(id1 AS VARCHAR) || ',' || CAST(id2 AS VARCHAR) AS pair_ids,
       CAST(2 AS BIGINT) AS n_ids FROM c""")
def array_build(spark, sf_dir):
    from .q_jobs import q1_counts
    arr = F.array("id1", "id2")
    return q1_counts(spark, sf_dir).select("id1", "id2", ids_text(arr).alias("pair_ids"),
                                           F.size(arr).cast("bigint").alias("n_ids"))


def _intersect_sizes(adj, block):
    pairs = lists.listed_pairs(adj)
    met = lists.common_blocks(adj, pairs, block)
    per_block = met.select("id1", "id2", shared_count("l1", "l2", exclude=["id1", "id2"]).alias("k"))
    return lists.sum_by_pair(per_block, pairs, "k")


@query("array_intersect_size", _ALL_COUNTS)
def array_intersect_size(spark, sf_dir):
    """A2/X8 in row form: both lists on one row (per id block), intersect, members left out,
    summed per pair; zeros kept."""
    return _intersect_sizes(adjacency(spark, sf_dir), lists.DEFAULT_BLOCK)


@query("array_intersect_size_narrow", _ALL_COUNTS)
def array_intersect_size_narrow(spark, sf_dir):
    """The same over lists cut into many lines and blocks."""
    return _intersect_sizes(adjacency(spark, sf_dir, "adjacency_narrow"), 8)


@query("array_intersect_size_bitmap", _ALL_COUNTS)
def array_intersect_size_bitmap(spark, sf_dir):
    """The same over lists packed into compressed bitmap blocks."""
    adj = adjacency(spark, sf_dir)
    return lists.shared_by_bitmaps(edges_from_adjacency(adj), lists.listed_pairs(adj))


@query("array_intersect_size_hubs", f"""{S.mutual(S.COSUPPLY_EDGES)}
SELECT p.id1, p.id2, COALESCE(c.n, 0) AS n FROM p LEFT JOIN c ON c.id1 = p.id1 AND c.id2 = p.id2""")
def array_intersect_size_hubs(spark, sf_dir):
    """The same where every link goes both ways and suppliers list most parts: long, dense lists."""
    edges = tables.cosupply(spark, sf_dir)
    return lists.shared_by_bitmaps(edges, reciprocal_pairs(edges))


@query("pred_boolean", """
SELECT l_orderkey, l_linenumber,
       (l_partkey <> l_suppkey AND l_quantity > 25) OR l_linenumber = 1 AS flag,
       NOT (l_discount < 0.05) AS high_discount FROM lineitem""")
def pred_boolean(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    flag = (((F.col("l_partkey") != F.col("l_suppkey")) & (F.col("l_quantity") > 25))
            | (F.col("l_linenumber") == 1))
    return li.select("l_orderkey", "l_linenumber", flag.alias("flag"),
                     (~(F.col("l_discount") < 0.05)).alias("high_discount"))


# ---------------- UDF surface ----------------


def _udf_counts(adj, block):
    cand = lists.candidate_blocks(adj, block)
    pairs = cand.where(reciprocal_udf("id1", "l1", "id2", "l2") == 1).select("id1", "id2")
    met = lists.common_blocks(adj, pairs, block)
    return lists.sum_by_pair(met.select("id1", "id2", shared_count_udf("l1", "l2", "id1", "id2").alias("k")), pairs, "k")


@query("udf_scalar_int", _ALL_COUNTS)
def udf_scalar_int(spark, sf_dir):
    """The reciprocity test and the shared count as vectorized UDFs returning INT.

    Candidates are the canonical keys of the listed links; the test reads the one block of each
    member's list that would hold the other; the count is summed over common blocks."""
    return _udf_counts(adjacency(spark, sf_dir), lists.DEFAULT_BLOCK)


@query("udf_scalar_int_narrow", _ALL_COUNTS)
def udf_scalar_int_narrow(spark, sf_dir):
    """The same over lists cut into many lines and blocks."""
    return _udf_counts(adjacency(spark, sf_dir, "adjacency_narrow"), 8)


@query("udf_scalar_string", f"""WITH b AS ({S.BUSINESSES}), r AS ({S.REVIEWS})
SELECT userid || chr(9) || CAST(stars AS VARCHAR) AS value FROM (
  SELECT DISTINCT r.businessid, r.userid, r.stars FROM r JOIN b ON b.businessid = r.businessid
  WHERE b.address LIKE '%{PATTERN}%') d""")
def udf_scalar_string(spark, sf_dir):
    """Q3 lines by a vectorized UDF returning STRING (same text as ``tab_line``)."""
    r = ratings_for(tables.businesses(spark, sf_dir), tables.reviews(spark, sf_dir), PATTERN, match="like")
    return r.select(tab_line_udf(F.col("userid"), F.col("stars")).alias("value"))


@query("udf_scalar_string_nulls", """
SELECT CAST(p_partkey AS VARCHAR) || chr(9) || COALESCE(CAST(CASE WHEN p_size > 25 THEN p_size END AS VARCHAR), 'None')
       AS value FROM part""")
def udf_scalar_string_nulls(spark, sf_dir):
    """U2 on a whole-number column with nulls: the numbers stay whole."""
    p = tables.table(spark, sf_dir, "part")
    return p.select(tab_line_udf("p_partkey", F.when(F.col("p_size") > 25, F.col("p_size"))).alias("value"))


@query("udf_scalar_float", f"""WITH r AS ({S.REVIEWS})
SELECT businessid, AVG(CAST(CAST(stars AS VARCHAR) AS FLOAT)) AS avg_stars FROM r GROUP BY businessid""")
def udf_scalar_float(spark, sf_dir):
    """Stars parsed from text by a vectorized UDF returning FLOAT, then the mean per business."""
    r = text.parse_records(lines(spark, sf_dir, "reviews"), ["reviewid", "userid", "businessid", "stars"])
    return mean_ratings(r.withColumn("stars", to_float_udf("stars")))


@query("line_builders", f"""{S.mutual()}
SELECT CAST(id1 AS VARCHAR) || chr(9) || CAST(id2 AS VARCHAR) || chr(9) || CAST(n AS VARCHAR) AS value
FROM c""")
def line_builders(spark, sf_dir):
    from .q_jobs import q1_counts
    return q1_counts(spark, sf_dir).select(tab_line("id1", "id2", "n").alias("value"))
