"""FIXTURES.md section 4: the rating fixture (D10-D14) through the record sources and Q3/Q4."""

import pytest

from conftest import write_lines_file
from mutualis.functions import tab_line
from mutualis.operators import mean_ratings, ratings_for, top_rated
from mutualis.sources import parse_businesses, parse_reviews, read_lines

BUSINESS = [
    "b1::1 Main, Stanford, CA 94305::List(Food)",
    "b1::1 Main, Stanford, CA 94305::List(Food)",
    "b2::2 Elm, Stanford, CA 94305::List(Bar)",
    "b3::3 Oak, Palo Alto, CA::List(Cafe)",
    "b4::4 Fir, stanford, ca::",
]
REVIEWS = ["r1::u1::b1::4.0", "r1::u1::b1::4.0", "r2::u1::b2::4.0", "r3::u2::b1::5.0", "r4::u3::b3::2.0",
           "r5::u1::b1::4.0"]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("ratings")
    b = parse_businesses(read_lines(spark, write_lines_file(d, "businesses.txt", BUSINESS)))
    r = parse_reviews(read_lines(spark, write_lines_file(d, "reviews.txt", REVIEWS)))
    return b, r


def test_record_parse_keeps_empty_last_field(data):
    b, r = data
    b4 = [row for row in b.collect() if row.businessid == "b4"][0]
    assert b4.categories == ""
    assert dict(r.dtypes)["stars"] == "double"


@pytest.mark.parametrize("match", ["contains", "like"])
def test_q3_per_business(data, match):
    b, r = data
    got = sorted(tuple(x) for x in ratings_for(b, r, per_business=True, match=match).collect())
    assert got == [("u1", 4.0), ("u1", 4.0), ("u2", 5.0)]


def test_q3_per_pair(data):
    b, r = data
    got = sorted(tuple(x) for x in ratings_for(b, r, per_business=False).collect())
    assert got == [("u1", 4.0), ("u2", 5.0)]


def test_q3_lines(data):
    b, r = data
    got = sorted(x.v for x in ratings_for(b, r).select(tab_line("userid", "stars").alias("v")).collect())
    assert got == ["u1\t4.0", "u1\t4.0", "u2\t5.0"]


def test_q4_every_line(data):
    b, r = data
    got = [(x.businessid, x.avg_stars) for x in top_rated(r, b, k=10).collect()]
    assert got == [("b1", 4.25), ("b2", 4.0), ("b3", 2.0)]  # b4 has no review; b1 line de-duplicated


def test_q4_distinct_lines(data):
    b, r = data
    got = {x.businessid: x.avg_stars for x in top_rated(r, b, k=10, dedup=True).collect()}
    assert got == {"b1": pytest.approx(13 / 3), "b2": 4.0, "b3": 2.0}


def test_q4_by_key(data):
    b, r = data
    got = [(x.businessid, x.avg_stars) for x in top_rated(r, b, k=10, by="key", dedup=True).collect()]
    assert [g[0] for g in got] == ["b3", "b2", "b1"]
    assert got[2][1] == pytest.approx(13 / 3)
    every = [(x.businessid, x.avg_stars) for x in top_rated(r, b, k=2, by="key").collect()]
    assert every == [("b3", 2.0), ("b2", 4.0)]


def test_q4_top1_and_columns(data):
    b, r = data
    res = top_rated(r, b, k=1)
    assert res.columns == ["businessid", "address", "categories", "avg_stars"]
    assert [tuple(x) for x in res.collect()] == [("b1", "1 Main, Stanford, CA 94305", "List(Food)", 4.25)]


def test_mean_ratings(data):
    _, r = data
    assert {x.businessid: x.avg_stars for x in mean_ratings(r).collect()} == {"b1": 4.25, "b2": 4.0, "b3": 2.0}
