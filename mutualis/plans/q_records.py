"""U4 and A1 with functions of the caller's own: map, flatMap, filter, reduce by key, and U1-U3 by a plain function."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import filter_records, flat_map_records, map_records, reduce_by_key
from ..functions.udfs import scalar_udf
from ..sources import tables
from . import sql as S
from .catalog import lines, query

_LISTED = "WITH e AS (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem)"


def pairs_of_line(line):
    """``user<TAB>id,id,..`` → (smaller id, larger id, user) for each id."""
    user, _, ids = line.value.partition("\t")
    for listed in ids.split(","):
        if listed.strip():
            yield min(int(user), int(listed)), max(int(user), int(listed)), int(user)


def _pairs(spark, sf_dir):
    return flat_map_records(lines(spark, sf_dir, "adjacency"), pairs_of_line, "id1 long, id2 long, lister long")


@query("rec_flat_map", f"{_LISTED} SELECT least(src, dst) AS id1, greatest(src, dst) AS id2, src AS lister FROM e")
def rec_flat_map(spark, sf_dir):
    """Adjacency lines to canonical pairs by a Python function."""
    return _pairs(spark, sf_dir)


@query("rec_filter", f"""{_LISTED}
SELECT least(src, dst) AS id1, greatest(src, dst) AS id2, src AS lister FROM e WHERE src < dst""")
def rec_filter(spark, sf_dir):
    """the pairs listed by their smaller id."""
    return filter_records(_pairs(spark, sf_dir), lambda r: r.lister == r.id1 and r.id1 < r.id2)


@query("rec_map", f"WITH r AS ({S.REVIEWS}) SELECT businessid, userid, stars, stars > 25 AS high FROM r")
def rec_map(spark, sf_dir):
    """U4: ``::`` records to typed rows by a Python function."""
    def parse(line):
        _, user, business, stars = line.value.split("::")
        return {"businessid": business, "userid": user, "stars": float(stars), "high": float(stars) > 25}

    return map_records(lines(spark, sf_dir, "reviews"), parse, "businessid string, userid string, stars double, high boolean")


@query("rec_reduce_by_key", f"""WITH r AS ({S.REVIEWS})
SELECT businessid, AVG(stars) AS avg_stars, COUNT(*) AS n FROM r GROUP BY businessid""")
def rec_reduce_by_key(spark, sf_dir):
    """A1/A3: sums and counts merged by a Python function, then divided."""
    pair = F.struct(F.col("stars").alias("total"), F.lit(1).cast("long").alias("n")).alias("value")
    rows = tables.reviews(spark, sf_dir).select("businessid", pair)
    merged = reduce_by_key(rows, "businessid", "value",
                           lambda a, b: {"total": a["total"] + b["total"], "n": a["n"] + b["n"]})
    return merged.select("businessid", (F.col("value.total") / F.col("value.n")).alias("avg_stars"), F.col("value.n").alias("n"))


@query("rec_reduce_pairs", f"""{_LISTED}, p AS (
  SELECT least(src, dst) AS id1, greatest(src, dst) AS id2, min(src) AS low, max(src) AS high FROM e GROUP BY 1, 2)
SELECT id1, id2 FROM p WHERE low <> high""")
def rec_reduce_pairs(spark, sf_dir):
    """Pairs listed both ways, as a reduce by the pair: who lists it, 3 for both."""
    side = F.when(F.col("lister") == F.col("id1"), 1).otherwise(2).alias("sides")
    met = reduce_by_key(_pairs(spark, sf_dir).select("id1", "id2", side), ["id1", "id2"], "sides", lambda a, b: a | b)
    return met.where("sides = 3").select("id1", "id2")


@query("udf_scalar_any", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN left(p_name, 3) || '-' || CAST(p_size AS VARCHAR) END AS tag FROM part""")
def udf_scalar_any(spark, sf_dir):
    """U1-U3 for any plain function of values: here text or null."""
    tag = scalar_udf(lambda name, size: f"{name[:3]}-{size}" if size > 25 else None, T.StringType())
    return tables.table(spark, sf_dir, "part").select("p_partkey", tag("p_name", "p_size").alias("tag"))
