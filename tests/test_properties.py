"""Property tests: shared-neighbour counts against plain Python sets on random small graphs."""

from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mutualis.operators import mutual_counts


def brute_force(edge_rows):
    nbrs = {}
    for s, d in edge_rows:
        if s != d:
            nbrs.setdefault(s, set()).add(d)
    out = set()
    for a, b in combinations(sorted(nbrs), 2):
        if b in nbrs[a] and a in nbrs.get(b, set()):
            n = len((nbrs[a] & nbrs[b]) - {a, b})
            if n:
                out.add((a, b, n))
    return out


graphs = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=0, max_size=80)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=graphs, hub=st.sampled_from([1, 3, 1000]))
def test_matches_brute_force(spark, rows, hub):
    df = spark.createDataFrame(rows, "src bigint, dst bigint")
    got = {tuple(r) for r in mutual_counts(df, hub_degree=hub).collect()}
    assert got == brute_force(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=graphs)
def test_strategies_agree_and_duplication_is_harmless(spark, rows):
    df = spark.createDataFrame(rows + rows[::2], "src bigint, dst bigint")
    a = {tuple(r) for r in mutual_counts(df, strategy="arrays").collect()}
    b = {tuple(r) for r in mutual_counts(df, strategy="probe").collect()}
    assert a == b == brute_force(rows)


def test_partition_count_does_not_matter(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "src bigint, dst bigint")
    one = {tuple(r) for r in mutual_counts(df.repartition(1)).collect()}
    many = {tuple(r) for r in mutual_counts(df.repartition(13)).collect()}
    assert one == many == brute_force(rows)


def test_hub_graph_routes_to_probe(spark):
    # Two hubs linked both ways to every node, plus a ring: hub pairs go the probe way.
    rows = []
    for h in (1000, 1001):
        for v in range(200):
            rows += [(h, v), (v, h)]
    rows += [(v, (v + 1) % 200) for v in range(200)] + [((v + 1) % 200, v) for v in range(200)]
    df = spark.createDataFrame(rows, "src bigint, dst bigint")
    got = {tuple(r) for r in mutual_counts(df, hub_degree=50).collect()}
    assert got == brute_force(rows)
