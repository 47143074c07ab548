"""Row-form list operators on the one-line-per-user layout: ids in any order, on both sides of the
block limit, repeated, with empty lists and users on several lines."""

import random

import pytest
from pyspark.sql import functions as F

from mutualis.functions import is_reciprocal, shared_count
from mutualis.functions.udfs import reciprocal_udf, shared_count_udf, tab_line_udf
from mutualis.operators import lists
from mutualis.sources import parse_adjacency, parse_businesses, parse_profiles, parse_reviews

LINES = ["1\t3,2000,1,2000", "3\t2000,1,1023,1024", "2000\t1,3,1024", "1024\t3,2000,7", "1023\t", "7\t1024,5000", "9\t-5,9",
         "7\t1,2", "-5\t9,1024"]


@pytest.fixture(scope="module")
def adj(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("adj") / "friends.txt"
    p.write_text("".join(x + "\n" for x in LINES))
    return parse_adjacency(spark.read.text(str(p)))


@pytest.fixture(scope="module")
def users():
    out = {}
    for x in LINES:
        u, f = x.split("\t")
        out.setdefault(int(u), set()).update(int(i) for i in f.split(",") if i)
    return out


def pairs_of(users):
    return {(a, b) for a in users for b in users[a] if a < b and a in users.get(b, ())}


def rows(df):
    return {tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()}


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_per_user_answers(spark, adj, users, block):
    assert rows(lists.whole_lists(adj, block)) == {(u, tuple(sorted(f))) for u, f in users.items()}
    assert rows(lists.list_sizes(adj, block)) == {(u, len(f)) for u, f in users.items()}
    assert rows(lists.first_ids(adj, 3, block)) == {(u, tuple(sorted(f)[:3])) for u, f in users.items()}
    asked = spark.createDataFrame([(u, i) for u in [*users, 77] for i in (1, 1024, 2000, -5)], "userid bigint, id bigint")
    assert rows(lists.lists_contain(adj, asked, block)) == {(u, i, i in users[u]) for u in users for i in (1, 1024, 2000, -5)}


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_per_pair_answers(adj, users, block):
    expected = pairs_of(users)
    cand = lists.candidate_blocks(adj, block)
    assert rows(cand.where(is_reciprocal("id1", "l1", "id2", "l2")).select("id1", "id2")) == expected
    assert rows(cand.where(reciprocal_udf("id1", "l1", "id2", "l2") == 1).select("id1", "id2")) == expected
    pairs = lists.listed_pairs(adj)
    assert rows(pairs) == expected
    assert rows(lists.union_sizes(adj, pairs, block)) == {(a, b, len(users[a] | users[b])) for a, b in expected}
    shared = {(a, b, len((users[a] & users[b]) - {a, b})) for a, b in expected}
    for count in (shared_count("l1", "l2", exclude=["id1", "id2"]), shared_count_udf("l1", "l2", "id1", "id2")):
        met = lists.common_blocks(adj, pairs, block).select("id1", "id2", count.alias("k"))
        assert rows(lists.sum_by_pair(met, pairs, "k")) == shared


def test_text_of_whole_numbers_beside_a_null(spark):
    df = spark.createDataFrame([(1, 3), (2, None)], "a bigint, b bigint").coalesce(1)
    assert {r[0] for r in df.select(tab_line_udf("a", "b")).collect()} == {"1\t3", "2\tNone"}
    nan = spark.createDataFrame([(float("nan"),), (None,)], "x double").coalesce(1)
    assert {r[0] for r in nan.select(tab_line_udf("x")).collect()} == {"NaN", "None"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_parsing_does_not_depend_on_the_session(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bad = [(parse_adjacency, "x\t1"), (parse_adjacency, "1\t2,y"), (parse_adjacency, "1"),
               (parse_profiles, "1,a,b"), (parse_profiles, "z,a,b,c,d,e,f,g,h,i"), (parse_businesses, "b::address"),
               (parse_reviews, "r::u::b::many"), (parse_reviews, "r::u::b")]
        for parse, line in bad:
            lines = spark.createDataFrame([(line,)], "value string")
            with pytest.raises(Exception, match="not a |record without field"):
                parse(lines).collect()
            got = parse(lines, permissive=True).first()
            # A missing list is an empty one.
            assert got[1] == [] if line == "1" else any(v is None or isinstance(v, list) and None in v for v in got)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_bitmaps_equal_sets(spark):
    """Ids on both sides of 0, of word and block limits and far out, repeated, null and the user's own."""
    rnd = random.Random(5)
    ids = [0, 1, -1, 63, 64, -64, -65, 4095, 4096, -4096, -4097, 1 << 40, -(1 << 62), (1 << 63) - 1, -(1 << 63), *range(200, 330)]
    users = {u: {rnd.choice(ids) for _ in range(rnd.choice([0, 1, 5, 90]))} for u in ids[:24]}
    users[63] = set(ids)  # dense
    rows = [(u, x) for u, own in users.items() for x in [*own, *own, u]] + [(None, 1), (1, None)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint")
    blocks = lists.bitmap_blocks(edges).collect()
    got = {}
    for r in blocks:
        words = [i for i in range(64) if r["mask"] >> i & 1]
        assert len(words) == len(r["words"]) and all(r["words"])
        for w, bits in zip(words, r["words"]):
            got.setdefault(r["userid"], []).extend(r["blk"] * 4096 + w * 64 + b for b in range(64) if bits >> b & 1)
    users = {u: own - {u} for u, own in users.items()}
    assert {u: sorted(x) for u, x in got.items()} == {u: sorted(own) for u, own in users.items() if own}
    pairs = [(a, b) for a in users for b in users if a < b]
    frame = spark.createDataFrame(pairs, "id1 bigint, id2 bigint")
    counts = {(r["id1"], r["id2"]): r["n"] for r in lists.shared_by_bitmaps(edges, frame).collect()}
    assert counts == {(a, b): len(users[a] & users[b]) for a, b in pairs}
    assert any(counts.values()) and not all(counts.values())
    assert lists.shared_by_bitmaps(edges.limit(0), frame.limit(0)).count() == 0


def test_bitmaps_stay_in_built_ins(spark):
    """A dense list takes a small part of an id array's bytes; no Python and no nested loop in the plan."""
    edges = spark.range(20_000).selectExpr("id % 2 as src", "id div 2 + 10 as dst")
    words = sum(1 + len(r["words"]) for r in lists.bitmap_blocks(edges).collect())
    assert words * 8 < 20_000 * 8 / 50
    frame = spark.createDataFrame([(0, 1)], "id1 bigint, id2 bigint")
    out = lists.shared_by_bitmaps(edges, frame)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "NestedLoop", "Cartesian"))
    assert [tuple(r) for r in out.collect()] == [(0, 1, 10_000)]


def test_bitmap_words_go_only_where_masks_meet(spark, monkeypatch):
    """Lists that share blocks but no word: words were sent to every such pair; pairs in either order."""
    seen, real = [], lists.sum_by_pair
    monkeypatch.setattr(lists, "sum_by_pair", lambda per, *args: seen.append(per) or real(per, *args))
    rows = [(u, 10_000 + 64 * u + x) for u in range(8) for x in range(5)] + [(7, 10_000)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint")
    asked = [(a, b) for a in range(8) for b in range(8) if a != b]
    out = lists.shared_by_bitmaps(edges, spark.createDataFrame(asked, "id1 bigint, id2 bigint"))
    assert {tuple(r) for r in out.collect()} == {(a, b, int({a, b} == {0, 7})) for a, b in asked}
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    masks = next(x for x in plan.splitlines() if "AS m1" in x)
    assert "words" not in masks  # the expanded pairs carry masks alone


def test_bitmaps_meet_in_rounds(spark, monkeypatch):
    """All pairs were expanded in one job: their masks and words lay on disk at once, until the driver collected its garbage."""
    rnd = random.Random(3)
    rows = [(u, rnd.randrange(40_000)) for u in range(40) for _ in range(rnd.choice([3, 60, 400]))]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint")
    users = {u: {x for v, x in rows if v == u} - {u} for u in range(40)}
    pairs = [(a, b) for a in range(40) for b in range(40) if a != b]
    seen, real = [], lists.materialize

    def spy(df, name, *args, **kw):
        seen.append((name, spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)))
        return real(df, name, *args, **kw)
    monkeypatch.setattr(lists, "materialize", spy)
    monkeypatch.setattr(lists, "ROUND_ROWS", 1)
    out = lists.shared_by_bitmaps(edges, spark.createDataFrame(pairs, "id1 bigint, id2 bigint"))
    assert seen.count(("shared", "true")) > 3 and {on for _, on in seen} == {"true"}
    assert seen.count(("bitmap_blocks", "true")) == lists.BLOCK_ROUNDS
    got = [tuple(r) for r in out.collect()]
    assert sorted(got) == sorted((a, b, len(users[a] & users[b])) for a, b in pairs)


def test_bitmap_words_sent_are_those_both_have(spark, monkeypatch):
    """A dense member's words all went to each pair."""
    rows = [(0, x) for x in range(8192, 12288)] + [(1, 8192), (1, 8300), (1, 20_000)]
    blocks = lists.bitmap_blocks(spark.createDataFrame(rows, "src bigint, dst bigint"))
    sized = spark.createDataFrame([(True, 1, 0)], "few boolean, s bigint, o bigint")
    assert [tuple(r) for r in lists._met(sized, blocks, 0, 1).collect()] == [(1, 0, 2)]
    monkeypatch.setattr(lists, "bits_in_common", lambda m1, w1, m2, w2: F.size(w2))
    assert [tuple(r) for r in lists._met(sized, blocks, 0, 1).collect()] == [(1, 0, 2)]  # 64 before
