"""Inputs built from the driver's parquet tables, standing for the original text files.

All are lazy projections of single-table scans, so filters and column pruning reach the parquet
reader and the work grows with the tables:

* ``supplies``   directed graph: part ``l_partkey`` lists supplier ``l_suppkey`` (one row per
                 lineitem, so lists repeat ids and a few parts list themselves).
* ``cosupply``   the same links in both directions (every link reciprocated; supplier ids are hubs).
* ``mixed``      parts next to each other in an order, linked both ways (short lists), and every part
                 linked both ways with its suppliers, whose ids are shifted (hubs).
* ``profiles``   ``part`` as user profiles (id, name, brand, type, ...).
* ``businesses`` ``part`` as businesses (id, name as address, brand as categories).
* ``reviews``    ``lineitem`` as reviews (order-line id, supplier as user, part as business,
                 quantity as stars; whole numbers, so sums and means are exact).
* ``reviews_dup`` reviews plus a second copy of the returned (``R``) lines: repeated lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from . import schemas as S


# Ids per line of the adjacency text form: a long list is written as several lines. Nothing that
# reads the lines depends on it.
LINE_IDS = 1024
# Shift that keeps supplier ids apart from part ids in ``mixed``.
HUB_SHIFT = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def cosupply(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = supplies(spark, sf_dir)
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear in the rows: each line gives two links with its supplier and two with the next part of
    its order (an order's lines are few)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    after = "lead(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey)"
    pairs = li.selectExpr("l_partkey as a", f"{after} as b").where("b is not null")
    pairs = pairs.unionByName(li.select(F.col("l_partkey").alias("a"), (F.col("l_suppkey") + HUB_SHIFT).alias("b")))
    return pairs.select(F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                                          F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))).alias("e")).select("e.*")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("userid"),
        F.col("p_name").alias("firstname"),
        F.col("p_brand").alias("lastname"),
        F.col("p_type").alias("address"),
        F.col("p_size").cast("string").alias("city"),
        F.lit("").alias("state"),
        F.format_string("%.2f", F.col("p_retailprice")).alias("zipcode"),
        F.upper(F.col("p_type")).alias("country"),
        F.concat(F.lit("user"), F.col("p_partkey").cast("string")).alias("username"),
        F.lit("").alias("dob"),
    )


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("businessid"),
        F.col("p_name").alias("address"),
        F.col("p_brand").alias("categories"),
    )


def _review_cols():
    return [
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("reviewid"),
        F.col("l_suppkey").cast("string").alias("userid"),
        F.col("l_partkey").cast("string").alias("businessid"),
        F.col("l_quantity").alias("stars"),
    ]


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_review_cols())


def reviews_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    again = li.where(F.col("l_returnflag") == "R")
    return li.select(*_review_cols()).unionByName(again.select(*_review_cols()))


# ---- text forms of the inputs (for the line sources and sinks) ----

def profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profiles(spark, sf_dir)
    return p.select(F.concat_ws(S.PROFILE_SEP, *[F.col(c).cast("string") for c in S.PROFILE_COLUMNS])
                    .alias("value"))


def adjacency_lines(spark: SparkSession, sf_dir: str, line_ids: int = LINE_IDS) -> DataFrame:
    """``part<TAB>sorted supplier ids``, one line per part and block of ``line_ids`` ids.

    A part's list is split over lines by id block (``id div line_ids``), so no line holds more
    than ``line_ids`` distinct ids however many suppliers a part has. Parts with no lineitem get one
    line with an empty list.
    """
    blocks = (supplies(spark, sf_dir)
              .groupBy("src", F.expr(f"dst div {line_ids}").alias("blk"))
              .agg(F.array_sort(F.collect_set("dst")).alias("ids")))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("src"))
    ids_text = F.array_join(F.transform(F.col("ids"), lambda x: x.cast("string")), S.FRIEND_SEP)
    return (parts.join(blocks, "src", "left")
            .select(F.concat(F.col("src").cast("string"), F.lit(S.ADJACENCY_SEP),
                             F.coalesce(ids_text, F.lit(""))).alias("value")))


def business_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = businesses(spark, sf_dir)
    return b.select(F.concat_ws(S.RECORD_SEP, *S.BUSINESS_COLUMNS).alias("value"))


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reviews(spark, sf_dir)
    return r.select(F.concat_ws(S.RECORD_SEP, "reviewid", "userid", "businessid",
                                F.col("stars").cast("string")).alias("value"))
