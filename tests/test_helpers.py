
import pytest
from pyspark.sql import functions as F

from mutualis.functions import canonical_pair, is_reciprocal, pair_line, shared_count, tab_line
from mutualis.functions.udfs import (
    reciprocal_udf, scalar_udf, shared_count_udf, tab_line_udf, to_float_udf,
)
from mutualis.operators import edges_from_adjacency
from mutualis.sources import parse_adjacency
from pyspark.sql import types as T

ROWS = [(1, [3, 5, 7, 9], 2, [6, 8]), (1, [3, 4, 5, 7, 9], 4, [1, 6, 8, 10])]


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame(ROWS, "u1 bigint, l1 array<bigint>, u2 bigint, l2 array<bigint>")


def test_reciprocity(lists):
    got = [r.ok for r in lists.select(is_reciprocal("u1", "l1", "u2", "l2").alias("ok")).collect()]
    assert got == [False, True]
    got = [r.ok for r in lists.select(reciprocal_udf("u1", "l1", "u2", "l2").alias("ok")).collect()]
    assert got == [0, 1]


def test_shared_count(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 4], [3, 4, 5, 6, 6])], "a array<bigint>, b array<bigint>")
    assert df.select(shared_count("a", "b").alias("n")).first().n == 2
    df2 = df.withColumn("x", F.lit(0).cast("bigint")).withColumn("y", F.lit(-1).cast("bigint"))
    assert df2.select(shared_count_udf("a", "b", "x", "y").alias("n")).first().n == 2
    assert df2.select(shared_count("a", "b", exclude=[F.lit(3)]).alias("n")).first().n == 1


def test_pair_and_tab_lines(spark):
    df = spark.createDataFrame([("1", "2", "3", "4", "5", "6", "7")], [f"c{i}" for i in range(7)])
    assert df.select(pair_line("c0", "c1", "c2").alias("v")).first().v == "1, 2\t3"
    assert df.select(tab_line(*df.columns).alias("v")).first().v == "1\t2\t3\t4\t5\t6\t7"
    assert df.select(tab_line("c0", "c1").alias("v")).first().v == "1\t2"
    assert df.select(tab_line("c0", "c1", "c2", "c3").alias("v")).first().v == "1\t2\t3\t4"
    assert df.select(tab_line_udf(F.col("c0"), F.col("c1")).alias("v")).first().v == "1\t2"


def test_null_fields_keep_their_place(spark):
    df = spark.createDataFrame([("a", None, 2.5)], "x string, y string, z double")
    assert df.select(tab_line("x", "y", "z").alias("v")).first().v == "a\t\t2.5"
    assert df.select(tab_line("x", "y", "z", null_text="None").alias("v")).first().v == "a\tNone\t2.5"
    assert df.select(tab_line_udf(F.col("x"), F.col("y"), F.col("z")).alias("v")).first().v == "a\tNone\t2.5"


def test_to_float(spark):
    df = spark.createDataFrame([("1.0",)], "s string")
    r = df.select(to_float_udf("s").alias("f"), F.col("s").cast("double").alias("d")).first()
    assert r.f == 1.0 and r.d == 1.0
    assert dict(df.select(to_float_udf("s").alias("f")).dtypes)["f"] == "float"


def test_strict_and_permissive_casts(spark, tmp_path):
    from mutualis.sources import parse_reviews, read_lines
    p = tmp_path / "r.txt"
    p.write_text("r1::u1::b1::x\n")
    lines = read_lines(spark, str(p))
    assert parse_reviews(lines, permissive=True).first().stars is None
    with pytest.raises(Exception):
        parse_reviews(lines).collect()


def test_mapper_example_canonical_keys(spark, tmp_path):
    p = tmp_path / "m.txt"
    p.write_text("9\t0,6085,18972,19269\n")
    edges = edges_from_adjacency(parse_adjacency(spark.read.text(str(p))))
    lo, hi = canonical_pair("src", "dst")
    got = sorted(tuple(r) for r in edges.select(lo, hi).collect())
    assert got == [(0, 9), (9, 6085), (9, 18972), (9, 19269)]


def test_scalar_udf_wrapper(spark):
    df = spark.createDataFrame([(1, 2), (5, 3)], "a bigint, b bigint")
    bigger = scalar_udf(lambda a, b: int(a > b), T.IntegerType())
    assert [r.x for r in df.select(bigger("a", "b").alias("x")).collect()] == [0, 1]


def test_blank_lines_are_skipped(spark, tmp_path):
    from mutualis.sources import parse_adjacency, parse_businesses, parse_profiles, read_lines
    p = tmp_path / "blank.txt"
    p.write_text("1\t2,3\n\n   \n2\t1\n")
    assert sorted(r.userid for r in parse_adjacency(read_lines(spark, str(p))).collect()) == [1, 2]
    q = tmp_path / "b.txt"
    q.write_text("b1::a::c\n\n")
    assert parse_businesses(read_lines(spark, str(q))).count() == 1
    u = tmp_path / "u.txt"
    u.write_text("7,A,B,C,D,E,F,G,H,I\n\n")
    assert [r.userid for r in parse_profiles(read_lines(spark, str(u))).collect()] == [7]


def test_text_sink_fails_when_path_exists(spark, tmp_path):
    from mutualis.sinks import write_lines
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    out = str(tmp_path / "lines")
    write_lines(df, out)
    with pytest.raises(Exception):
        write_lines(df, out)
    write_lines(df, out, mode="overwrite")
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        write_lines(df.withColumn("x", F.lit(1)), str(tmp_path / "two_columns"))


def test_permissive_parsing_turns_bad_ids_into_null(spark, tmp_path):
    from mutualis.sources import parse_adjacency, parse_profiles, read_lines
    a = tmp_path / "adj.txt"
    a.write_text("x\t1,y,2\n3\t4\n")
    adj = {r.userid: r.friend_list for r in parse_adjacency(read_lines(spark, str(a)), permissive=True).collect()}
    assert adj == {None: [1, None, 2], 3: [4]}
    with pytest.raises(Exception):
        parse_adjacency(read_lines(spark, str(a))).collect()
    u = tmp_path / "u.txt"
    u.write_text("q,A,B\n")
    r = parse_profiles(read_lines(spark, str(u)), permissive=True).first()
    assert r.userid is None and r.firstname == "A" and r.address is None  # short line: missing fields null


def test_edges_drop_null_ids(spark):
    from mutualis.operators import clean_edges
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None), (1, 2)], "src bigint, dst bigint")
    assert [tuple(r) for r in clean_edges(df).collect()] == [(1, 2)]
