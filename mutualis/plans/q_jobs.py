"""The four questions on the table-backed inputs, and once more from their text forms."""

from __future__ import annotations

from ..functions import pair_line, tab_line
from ..operators import mutual_counts, ratings_for, top_pairs, top_pairs_with_profiles, top_rated
from ..sources import tables, text
from . import sql as S
from .catalog import graph, lines, query

K = 10
PATTERN = "red"  # address text picked on the test tables (part names)


def q1_counts(spark, sf_dir, strategy="auto"):
    return mutual_counts(graph(spark, sf_dir, "supplies"), strategy=strategy)


@query("q1_mutual_counts", f"{S.mutual()} SELECT id1, id2, n FROM c")
def q1_mutual_counts(spark, sf_dir):
    return q1_counts(spark, sf_dir)


@query("q1_mutual_counts_cosupply", f"{S.mutual(S.COSUPPLY_EDGES)} SELECT id1, id2, n FROM c")
def q1_mutual_counts_cosupply(spark, sf_dir):
    """Q1 on the symmetric graph: every link reciprocated, supplier ids as hubs (the heavy case)."""
    return mutual_counts(graph(spark, sf_dir, "cosupply"))


@query("q1_from_text", f"{S.mutual()} SELECT id1, id2, n FROM c")
def q1_from_text(spark, sf_dir):
    """Q1 end to end from text: adjacency text lines → parsed lists → edges → counts."""
    return mutual_counts(graph(spark, sf_dir, "text"))


@query("q1_mutual_lines", f"""{S.mutual()}
SELECT CAST(id1 AS VARCHAR) || ', ' || CAST(id2 AS VARCHAR) || chr(9) || CAST(n AS VARCHAR) AS value
FROM c""")
def q1_mutual_lines(spark, sf_dir):
    c = q1_counts(spark, sf_dir)
    return c.select(pair_line("id1", "id2", "n").alias("value"))


def _q2_sql():
    top = "SELECT id1, id2, n FROM c ORDER BY n DESC, id1, id2 LIMIT 10"
    return f"""{S.mutual()}, t AS ({top}), pr AS ({S.PROFILES})
SELECT t.n, a.firstname AS a_first, a.lastname AS a_last, a.address AS a_address,
       b.firstname AS b_first, b.lastname AS b_last, b.address AS b_address
FROM t JOIN pr a ON a.userid = t.id1 JOIN pr b ON b.userid = t.id2"""


@query("q2_top_pairs", _q2_sql())
def q2_top_pairs(spark, sf_dir):
    res = top_pairs_with_profiles(q1_counts(spark, sf_dir), tables.profiles(spark, sf_dir), K)
    return res.select("n", "a_first", "a_last", "a_address", "b_first", "b_last", "b_address")


@query("q2_top_pairs_lines", f"""WITH q AS ({_q2_sql()})
SELECT CAST(n AS VARCHAR) || chr(9) || a_first || chr(9) || a_last || chr(9) || a_address || chr(9)
       || b_first || chr(9) || b_last || chr(9) || b_address AS value FROM q""")
def q2_top_pairs_lines(spark, sf_dir):
    r = q2_top_pairs(spark, sf_dir)
    return r.select(tab_line(*r.columns).alias("value"))


@query("q3_ratings_keyed", f"""WITH b AS ({S.BUSINESSES}), r AS ({S.REVIEWS})
SELECT userid, stars FROM (
  SELECT DISTINCT r.businessid, r.userid, r.stars FROM r JOIN b ON b.businessid = r.businessid
  WHERE b.address LIKE '%{PATTERN}%') d""")
def q3_ratings_keyed(spark, sf_dir):
    return ratings_for(tables.businesses(spark, sf_dir), tables.reviews(spark, sf_dir), PATTERN,
                       per_business=True, match="like")


@query("q3_ratings_pairs", f"""WITH b AS ({S.BUSINESSES}), r AS ({S.REVIEWS})
SELECT DISTINCT r.userid, r.stars FROM r JOIN b ON b.businessid = r.businessid
WHERE contains(b.address, '{PATTERN}')""")
def q3_ratings_pairs(spark, sf_dir):
    return ratings_for(tables.businesses(spark, sf_dir), tables.reviews(spark, sf_dir), PATTERN,
                       per_business=False, match="contains")


@query("q3_ratings_lines", f"""WITH b AS ({S.BUSINESSES}), r AS ({S.REVIEWS})
SELECT userid || chr(9) || CAST(stars AS VARCHAR) AS value FROM (
  SELECT DISTINCT r.businessid, r.userid, r.stars FROM r JOIN b ON b.businessid = r.businessid
  WHERE b.address LIKE '%{PATTERN}%') d""")
def q3_ratings_lines(spark, sf_dir):
    r = q3_ratings_keyed(spark, sf_dir)
    return r.select(tab_line("userid", "stars").alias("value"))


def _q4_sql(reviews_sql, dedup, order):
    src = "SELECT DISTINCT * FROM r0" if dedup else "SELECT * FROM r0"
    return f"""WITH r0 AS ({reviews_sql}), r AS ({src}), b AS ({S.BUSINESSES}),
m AS (SELECT businessid, AVG(stars) AS avg_stars FROM r GROUP BY businessid),
t AS (SELECT * FROM m ORDER BY {order} LIMIT {K})
SELECT DISTINCT b.businessid, b.address, b.categories, t.avg_stars
FROM b JOIN t ON t.businessid = b.businessid"""


@query("q4_top_rated", _q4_sql(S.REVIEWS, False, "avg_stars DESC, businessid"))
def q4_top_rated(spark, sf_dir):
    return top_rated(tables.reviews(spark, sf_dir), tables.businesses(spark, sf_dir), K)


@query("q4_top_rated_dedup", _q4_sql(S.REVIEWS_DUP, True, "avg_stars DESC, businessid"))
def q4_top_rated_dedup(spark, sf_dir):
    return top_rated(tables.reviews_dup(spark, sf_dir), tables.businesses(spark, sf_dir), K, dedup=True)


@query("q4_top_rated_all_lines", _q4_sql(S.REVIEWS_DUP, False, "avg_stars DESC, businessid"))
def q4_top_rated_all_lines(spark, sf_dir):
    """Same input as the dedup form, every line averaged (D12): the two results differ."""
    return top_rated(tables.reviews_dup(spark, sf_dir), tables.businesses(spark, sf_dir), K)


@query("q4_top_by_key", _q4_sql(S.REVIEWS_DUP, True, "businessid DESC"))
def q4_top_by_key(spark, sf_dir):
    return top_rated(tables.reviews_dup(spark, sf_dir), tables.businesses(spark, sf_dir), K,
                     by="key", dedup=True)


@query("q4_top_rated_lines", f"""WITH q AS ({_q4_sql(S.REVIEWS, False, "avg_stars DESC, businessid")})
SELECT businessid || chr(9) || address || chr(9) || categories || chr(9) || CAST(avg_stars AS VARCHAR)
AS value FROM q""")
def q4_top_rated_lines(spark, sf_dir):
    r = q4_top_rated(spark, sf_dir)
    return r.select(tab_line("businessid", "address", "categories", "avg_stars").alias("value"))


@query("q1_arrays", f"{S.mutual()} SELECT id1, id2, n FROM c")
def q1_arrays(spark, sf_dir):
    """C1 with every pair the arrays way."""
    return q1_counts(spark, sf_dir, strategy="arrays")


_MIXED = S.mutual(S.MIXED_EDGES, f"m AS ({S.MIXED}), ")


@query("q1_mixed", f"{_MIXED} SELECT id1, id2, n FROM c")
def q1_mixed(spark, sf_dir):
    """C1 on a graph with short lists and hubs: short lists of higher neighbours go the arrays way, long
    ones the probe way, in one plan."""
    return mutual_counts(graph(spark, sf_dir, "mixed"))


@query("q1_mixed_arrays", f"{_MIXED} SELECT id1, id2, n FROM c")
def q1_mixed_arrays(spark, sf_dir):
    """The same with every list the arrays way: long lists are cut into parts."""
    return mutual_counts(graph(spark, sf_dir, "mixed"), strategy="arrays")


@query("q2_mixed", f"{_MIXED} SELECT id1, id2, n FROM c ORDER BY n DESC, id1, id2 LIMIT {K}")
def q2_mixed(spark, sf_dir):
    """The pairs that share most on the mixed graph."""
    return top_pairs(mutual_counts(graph(spark, sf_dir, "mixed")), K)


@query("q1_probe", f"{S.mutual()} SELECT id1, id2, n FROM c")
def q1_probe(spark, sf_dir):
    """C1 with every pair the probe way."""
    return q1_counts(spark, sf_dir, strategy="probe")


@query("q2_top_pairs_left", f"""{S.mutual()},
t AS (SELECT id1, id2, n FROM c ORDER BY n DESC, id1, id2 LIMIT {K}), pr AS ({S.PROFILES})
SELECT t.n, a.firstname AS a_first, a.lastname AS a_last, a.address AS a_address,
       b.firstname AS b_first, b.lastname AS b_last, b.address AS b_address
FROM t LEFT JOIN pr a ON a.userid = t.id1 LEFT JOIN pr b ON b.userid = t.id2""")
def q2_top_pairs_left(spark, sf_dir):
    """C3 keeping pairs whose members lack a profile (D8 ``left``)."""
    res = top_pairs_with_profiles(q1_counts(spark, sf_dir), tables.profiles(spark, sf_dir), K, how="left")
    return res.select("n", "a_first", "a_last", "a_address", "b_first", "b_last", "b_address")


def _text_inputs(spark, sf_dir):
    return (text.parse_businesses(lines(spark, sf_dir, "businesses")),
            text.parse_reviews(lines(spark, sf_dir, "reviews")))


@query("q3_from_text", f"""WITH b AS ({S.BUSINESSES}), r AS ({S.REVIEWS})
SELECT userid, stars FROM (
  SELECT DISTINCT r.businessid, r.userid, r.stars FROM r JOIN b ON b.businessid = r.businessid
  WHERE b.address LIKE '%{PATTERN}%') d""")
def q3_from_text(spark, sf_dir):
    """C4 end to end from text: business and review text records parsed, then matched."""
    b, r = _text_inputs(spark, sf_dir)
    return ratings_for(b, r, PATTERN, per_business=True, match="like")


@query("q4_from_text", _q4_sql(S.REVIEWS, False, "avg_stars DESC, businessid"))
def q4_from_text(spark, sf_dir):
    """C6 from the parsed text records."""
    b, r = _text_inputs(spark, sf_dir)
    return top_rated(r, b, K)


@query("q4_top_by_key_all_lines", _q4_sql(S.REVIEWS_DUP, False, "businessid DESC"))
def q4_top_by_key_all_lines(spark, sf_dir):
    """C8 averaging every line, repeats included (D12 with D13)."""
    return top_rated(tables.reviews_dup(spark, sf_dir), tables.businesses(spark, sf_dir), K, by="key")


@query("q1_keep_zero", f"""{S.mutual()}
SELECT p.id1, p.id2, COALESCE(c.n, 0) AS n FROM p LEFT JOIN c ON c.id1 = p.id1 AND c.id2 = p.id2""")
def q1_keep_zero(spark, sf_dir):
    """C1 keeping reciprocated pairs that share nobody (``n = 0``)."""
    return mutual_counts(graph(spark, sf_dir, "supplies"), keep_zero=True)
