"""Record functions, exact means, bounded smallest-k and list UDFs."""

import cProfile
import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from mutualis.functions import filter_records, flat_map_records, map_records, records, reduce_by_key
from mutualis.functions.means import exact_mean
from mutualis.functions.udfs import reciprocal_udf, shared_count_udf
from mutualis.operators import lists
from mutualis.plans import QUERIES, catalog


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def some(spark):
    return spark.createDataFrame([(1, "a b", None), (2, None, 2.5), (None, "", 0.5), (2, None, 2.5)],
                                 "k long, t string, x double").repartition(3)


def test_map_gets_nulls_and_names(spark, some):
    got = map_records(some, lambda r: (r.k, None if r["t"] is None else len(r.t), r[2]), "k long, n int, x double")
    assert rows(got) == sorted([(1, 3, None), (2, None, 2.5), (2, None, 2.5), (None, 0, 0.5)], key=repr)
    by_name = map_records(some, lambda r: {"x": r.x}, T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType())]))
    assert rows(by_name) == sorted([(None, None), (None, 2.5), (None, 2.5), (None, 0.5)], key=repr)


def test_flat_map_gives_none_or_many(spark, some):
    got = flat_map_records(some, lambda r: ((w,) for w in (r.t or "").split()), "w string")
    assert rows(got) == [("a",), ("b",)]
    many = flat_map_records(spark.range(2), lambda r: ((i, [i, None]) for i in range(20_000)), "i long, l array<long>")
    assert many.count() == 40_000 and many.where("l[0] = i and l[1] is null").count() == 40_000


def test_filter_keeps_columns(spark, some):
    got = filter_records(some, lambda r: r.k and r.k > 1)
    assert got.schema == some.schema and rows(got) == [(2, None, 2.5)] * 2


def test_empty_inputs_call_nothing(spark, some):
    def fail(*_):
        raise AssertionError("called")
    none = some.where("k > 10")
    assert map_records(none, fail, "x int").count() == filter_records(none, fail).count() == 0
    assert flat_map_records(none, fail, "x int").count() == reduce_by_key(none, "k", "x", fail).count() == 0


@pytest.mark.parametrize("fn, text", [(lambda r: (1, 2), "expected 1 fields"), (lambda r: 5, "expected 1 fields"),
                                      (lambda r: {"y": 1}, "not in the stated schema"), (lambda r: 1 // 0, "ZeroDivisionError")])
def test_errors_fail_the_job(spark, some, fn, text):
    with pytest.raises(Exception, match=text):
        map_records(some, fn, "x int").collect()


def test_reduce_with_a_hot_key(spark, monkeypatch):
    """A third of all rows have one key, keys do not fit at once, null and NaN are keys."""
    monkeypatch.setattr(records, "HELD", 50)
    df = spark.range(30_000).repartition(9).select(
        F.when(F.col("id") % 3 == 0, -1.0).when(F.col("id") % 3 == 1, F.col("id").cast("double"))
        .when(F.col("id") % 2 == 0, float("nan")).alias("k"), F.col("id").alias("v"))
    got = {("nan" if k is not None and math.isnan(k) else k): v
           for k, v in reduce_by_key(df, "k", "v", lambda a, b: a + b, salts=4).collect()}
    want = {-1.0: sum(range(0, 30_000, 3)), "nan": sum(i for i in range(2, 30_000, 3) if i % 2 == 0),
            None: sum(i for i in range(2, 30_000, 3) if i % 2), **{float(i): i for i in range(1, 30_000, 3)}}
    assert got == want


def test_reduce_gives_null_values_to_the_function(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("b", None), ("c", 3)], "k string, v int")
    got = dict(map(tuple, reduce_by_key(df, "k", "v", lambda a, b: (a or 0) + (b or 0)).collect()))
    assert got == {"a": 2, "b": None, "c": 3}
    with pytest.raises(TypeError, match="cannot be a key"):
        reduce_by_key(df.select(F.array("k").alias("k"), "v"), "k", "v", max)


def test_means_do_not_depend_on_the_partitioning(spark):
    rng = random.Random(2)
    values = [rng.choice([0.1, 0.2, 0.3, 1 / 3, 4.7, -2.9, 1e-9, 1e5 + 0.1]) for _ in range(3000)]
    seen = set()
    for n in (1, 2, 7, 13):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(n)
        seen.add(df.agg(exact_mean("x").alias("m")).first()["m"])
    assert len(seen) == 1
    assert abs(seen.pop() - math.fsum(values) / len(values)) <= 1e-15 * max(map(abs, values))


def test_means_of_unusual_values(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, None), (2, 3.0), (2, None), (3, inf), (3, 1.0), (4, nan), (4, 1.0), (5, 1e300), (5, 1e300), (6, -0.5)],
                               "k int, x double")
    got = dict(map(tuple, df.groupBy("k").agg(exact_mean("x")).collect()))
    assert got.pop(4) != got.get(4) and got == {1: None, 2: 3.0, 3: inf, 5: 1e300, 6: -0.5}


def test_smallest_ids_are_limited_before_they_are_gathered(spark):
    p = QUERIES["array_slice"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert p.count("WindowGroupLimit") >= 2  # in each task before the shuffle, and after it
    adj = spark.createDataFrame([(1, [5, 3, 3, None]), (1, [9, 1]), (2, []), (3, None)], "userid long, friend_list array<long>")
    assert rows(lists.first_ids(adj, 2)) == [(1, [1, 3]), (2, []), (3, [])]


def test_list_udfs_equal_python_sets(spark):
    rng = random.Random(8)

    def ids():
        return rng.choice([None, [rng.choice([None, *range(8)]) for _ in range(rng.randrange(9))]])
    data = [(rng.choice([None, *range(8)]), ids(), rng.choice([None, *range(8)]), ids()) for _ in range(400)]
    df = spark.createDataFrame(data, "a long, x array<long>, b long, y array<long>")
    got = df.select("*", reciprocal_udf("a", "x", "b", "y").alias("r"), shared_count_udf("x", "y", "a", "b").alias("n")).collect()
    for a, x, b, y, r, n in got:
        x, y = set(x or []) - {None}, set(y or []) - {None}
        assert r == int(a in y and b in x) and n == len((x & y) - {a, b})
    empty = df.where("a > 100").select(shared_count_udf("x", "y", "a", "b"))
    assert empty.count() == 0


def test_list_udfs_on_text(spark):
    df = spark.createDataFrame([("u", ["v", "w"], "v", ["u", "w", "w"])], "a string, x array<string>, b string, y array<string>")
    assert df.select(reciprocal_udf("a", "x", "b", "y"), shared_count_udf("x", "y", "a", "b")).first()[:] == (1, 1)


def test_record_queries_read_the_text_lines(spark):
    assert catalog.lines(spark, SF_SMALL, "adjacency").count() > 0
    assert QUERIES["rec_filter"](spark, SF_SMALL).where("id1 >= id2").count() == 0


def _calls(batches):
    """Python calls that running through the batches makes, and their records."""
    profile, n = cProfile.Profile(), 0
    profile.enable()
    for b in batches:
        n += b.num_rows
    profile.disable()
    return sum(x.callcount for x in profile.getstats()), n


def test_little_is_called_for_each_record():
    """A row, its results and their batch cost a few calls a result, a merge little more than its function."""
    few = pa.RecordBatch.from_pydict({"id": list(range(1000))})
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    calls, n = _calls(records._each([few], lambda r: [(r[0], i) for i in range(30)], out))
    assert n == 30_000 and calls < 6 * n
    many = pa.RecordBatch.from_pydict({"k": [i % 10 for i in range(20_000)], "v": [1] * 20_000})
    out = pa.schema([("k", pa.int64()), ("v", pa.int64())])
    calls, n = _calls(records._merged([many], lambda a, b: a + b, 1, [], out))
    assert n == 10 and calls < 3 * 20_000
