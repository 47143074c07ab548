"""SC1-SC6, SK1-SK4: line sources read back from the text forms, and the line sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pair_line, tab_line
from ..operators import whole_lists
from ..session import scratch_path
from ..sinks import write_lines
from ..sources import schemas, tables, text
from . import sql as S
from .catalog import ids_text, lines, query, text_form
from .q_jobs import q1_counts

# Labels of the return flags, a parameter table for ``src_inline_rows``.
RETURN_FLAG_LABELS = [("A", "accepted"), ("N", "none"), ("R", "returned")]


@query("src_text_lines", """
SELECT CAST(p_partkey AS VARCHAR) || '::' || p_name || '::' || p_brand AS value FROM part""")
def src_text_lines(spark, sf_dir):
    return lines(spark, sf_dir, "businesses")


@query("src_profile_records", S.PROFILES)
def src_profile_records(spark, sf_dir):
    return text.parse_profiles(lines(spark, sf_dir, "profiles"))


@query("src_adjacency_lines", f"""WITH a AS ({S.ADJACENCY})
SELECT userid, array_to_string(friend_list, ',') AS friends, CAST(len(friend_list) AS BIGINT) AS n_friends
FROM a""")
def src_adjacency_lines(spark, sf_dir):
    """SC3: the parsed lines, a user's lines put together."""
    adj = whole_lists(text.parse_adjacency(lines(spark, sf_dir, "adjacency")))
    return adj.select("userid", ids_text("friend_list").alias("friends"),
                      F.size("friend_list").cast("bigint").alias("n_friends"))


@query("src_multichar_records", S.REVIEWS)
def src_multichar_records(spark, sf_dir):
    return text.parse_reviews(lines(spark, sf_dir, "reviews"))


@query("src_business_records", S.BUSINESSES)
def src_business_records(spark, sf_dir):
    return text.parse_businesses(lines(spark, sf_dir, "businesses"))


@query("src_inline_rows", f"""
WITH f(l_returnflag, label) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in RETURN_FLAG_LABELS)})
SELECT f.label, COUNT(*) AS n_lines FROM lineitem JOIN f USING (l_returnflag) GROUP BY f.label""")
def src_inline_rows(spark, sf_dir):
    labels = text.inline_rows(spark, RETURN_FLAG_LABELS, "l_returnflag string, label string")
    li = tables.table(spark, sf_dir, "lineitem")
    # A literal table of three rows: broadcasting it is bounded by construction.
    return (li.join(F.broadcast(labels), "l_returnflag").groupBy("label")
            .agg(F.count(F.lit(1)).alias("n_lines")))


@query("src_named_schema", S.REVIEWS)
def src_named_schema(spark, sf_dir):
    """SC6 through the CSV reader: positional ``_c0..`` columns, then the fixed names and types."""
    raw = (spark.read.schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(4)]))
           .option("sep", schemas.RECORD_SEP).csv(text_form(spark, sf_dir, "reviews")))
    df = text.named(raw, schemas.REVIEW_COLUMNS)
    return df.withColumn("stars", F.col("stars").cast("double"))


@query("sink_text_roundtrip", f"""{S.mutual()}
SELECT CAST(id1 AS VARCHAR) || ', ' || CAST(id2 AS VARCHAR) || chr(9) || CAST(n AS VARCHAR) AS value
FROM c""")
def sink_text_roundtrip(spark, sf_dir):
    """SK1/SK2: Q1 lines written as text files, then read back."""
    path = scratch_path(spark, "q1_lines.txt")
    write_lines(q1_counts(spark, sf_dir), path, line=pair_line("id1", "id2", "n"))
    return text.read_lines(spark, path)


@query("sink_pair_line", """
SELECT CAST(l_orderkey AS VARCHAR) || ', ' || CAST(l_linenumber AS VARCHAR) || chr(9)
       || CAST(l_partkey AS VARCHAR) AS value FROM lineitem""")
def sink_pair_line(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    return li.select(pair_line("l_orderkey", "l_linenumber", "l_partkey").alias("value"))


@query("sink_tab_line", """
SELECT CAST(p_partkey AS VARCHAR) || chr(9) || p_name || chr(9) || p_brand || chr(9)
       || COALESCE(CASE WHEN p_size > 25 THEN p_type END, '') || chr(9) || CAST(p_size AS VARCHAR)
       AS value FROM part""")
def sink_tab_line(spark, sf_dir):
    p = tables.table(spark, sf_dir, "part")
    return p.select(tab_line("p_partkey", "p_name", "p_brand",
                             F.when(F.col("p_size") > 25, F.col("p_type")), "p_size").alias("value"))
