"""FIXTURES.md section 3: the graph fixture (D1-D8) through the text sources and Q1/Q2."""

import pytest
from pyspark.sql import functions as F

from conftest import write_lines_file
from mutualis.functions import pair_line, tab_line
from mutualis.operators import (
    edges_from_adjacency, mutual_counts, reciprocal_pairs, reciprocal_pairs_by_self_join, clean_edges,
    top_pairs_with_profiles,
)
from mutualis.sources import parse_adjacency, parse_profiles, read_lines

GRAPH = [
    "1\t2,3,4", "2\t1,3,4", "3\t1,2", "4\t1,2,3",
    "5\t",
    "6\t1,",
    "7\t7,8,1", "8\t7",
    "9\t10,10,11", "10\t9,11", "11\t9,10", "11\t9,10",
]
EXPECTED_Q1 = {(1, 2, 2), (1, 3, 1), (1, 4, 2), (2, 3, 1), (2, 4, 2), (9, 10, 1), (9, 11, 1), (10, 11, 1)}
PROFILES = [
    "1,Ann,Lee,1 First St,Town,ST,00001,US,ann,1990-01-01",
    "2,Bob,Kim,2 Second St,Town,ST,00002,US,bob,1991-02-02",
    "3,Cy,Ng,3 Third St,Town,ST,00003,US,cy,1992-03-03",
]


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    path = write_lines_file(tmp_path_factory.mktemp("graph"), "friends.txt", GRAPH)
    return edges_from_adjacency(parse_adjacency(read_lines(spark, path)))


@pytest.fixture(scope="module")
def profiles(spark, tmp_path_factory):
    path = write_lines_file(tmp_path_factory.mktemp("prof"), "users.txt", PROFILES)
    return parse_profiles(read_lines(spark, path))


def _rows(df):
    return {tuple(r) for r in df.collect()}


def test_adjacency_parse_types(spark, tmp_path):
    path = write_lines_file(tmp_path, "a.txt", ["5\t", "6\t1,", "9\t10,10,11"])
    adj = parse_adjacency(read_lines(spark, path))
    assert adj.schema.simpleString() == "struct<userid:bigint,friend_list:array<bigint>>"
    got = {r.userid: r.friend_list for r in adj.collect()}
    assert got == {5: [], 6: [1], 9: [10, 10, 11]}


@pytest.mark.parametrize("strategy", ["auto", "arrays", "probe"])
def test_q1_expected(edges, strategy):
    assert _rows(mutual_counts(edges, strategy=strategy)) == EXPECTED_Q1


def test_q1_routed_with_tiny_hub_threshold(edges):
    # Degree threshold 2 sends pairs touching users 1, 2, 4, 9, ... to the probe way.
    assert _rows(mutual_counts(edges, hub_degree=2)) == EXPECTED_Q1


def test_q1_keep_zero_has_self_listing_pair(edges):
    got = _rows(mutual_counts(edges, keep_zero=True))
    assert (7, 8, 0) in got  # D3: 7 listing itself is not a shared friend of (7, 8)
    assert got - {(7, 8, 0)} == EXPECTED_Q1


def test_reciprocal_pairs_both_forms(edges):
    e = clean_edges(edges)
    expected = {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (7, 8), (9, 10), (9, 11), (10, 11)}
    assert _rows(reciprocal_pairs(e)) == expected
    assert _rows(reciprocal_pairs_by_self_join(e)) == expected  # D1: (3, 4) and (1, 6) absent


def test_q1_lines(edges):
    lines = {r.value for r in mutual_counts(edges).select(pair_line("id1", "id2", "n").alias("value")).collect()}
    assert "1, 2\t2" in lines and "10, 11\t1" in lines and len(lines) == 8


def test_q2_top3_inner_and_left(edges, profiles):
    counts = mutual_counts(edges)
    top = top_pairs_with_profiles(counts, profiles, k=3, how="left").collect()
    assert [(r.id1, r.id2, r.n) for r in top] == [(1, 2, 2), (1, 4, 2), (2, 4, 2)]  # D6 tie-break
    assert top[0].a_first == "Ann" and top[0].b_first == "Bob"  # D7: A is the smaller id
    assert top[1].b_first is None and top[1].b_address is None  # D8: user 4 has no profile
    inner = top_pairs_with_profiles(counts, profiles, k=3).collect()
    assert [(r.id1, r.id2) for r in inner] == [(1, 2)]


def test_q2_top4_adds_next_rank(edges, profiles):
    top = top_pairs_with_profiles(mutual_counts(edges), profiles, k=4, how="left").collect()
    assert [(r.id1, r.id2) for r in top] == [(1, 2), (1, 4), (2, 4), (1, 3)]


def test_q2_line_has_seven_fields(edges, profiles):
    r = top_pairs_with_profiles(mutual_counts(edges), profiles, k=1)
    line = r.select(tab_line("n", "a_first", "a_last", "a_address", "b_first", "b_last", "b_address")
                    .alias("v")).first().v
    assert line == "2\tAnn\tLee\t1 First St\tBob\tKim\t2 Second St"


def test_line_order_and_duplication_do_not_matter(spark, tmp_path):
    shuffled = list(reversed(GRAPH)) + GRAPH[:4]
    path = write_lines_file(tmp_path, "soc2.txt", shuffled)
    e = edges_from_adjacency(parse_adjacency(read_lines(spark, path)))
    assert _rows(mutual_counts(e)) == EXPECTED_Q1
    assert mutual_counts(e).where(F.col("n") > 0).count() == 8


def test_attach_profiles_with_other_fields(edges, profiles):
    from mutualis.operators import attach_profiles, top_pairs
    res = attach_profiles(top_pairs(mutual_counts(edges), 1), profiles, fields=("city", "username"))
    assert res.columns == ["id1", "id2", "n", "a_city", "a_username", "b_city", "b_username"]
    r = res.first()
    assert (r.a_username, r.b_username) == ("ann", "bob")
