"""Sharding, top-k search, URL filter, WARC, mixing and components against brute force."""

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mutualis.llm import covertree, mixing, shards, urls, warc
from mutualis.llm.components import components


# -- sharding

def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", 0, "x") for i, t in rows], "doc_id long, text string, shard string, slot int, id string")


def test_differencing_is_tight():
    rnd = random.Random(1)
    w = [int(rnd.paretovariate(1.2) * 100) for _ in range(3000)]
    part = shards.differencing(w, 8)
    sums = [sum(x for x, p in zip(w, part) if p == k) for k in range(8)]
    assert max(sums) - min(sums) <= max(2, max(w) - sum(w) // 8)
    assert shards.differencing([8, 7, 6, 5, 4], 2) in ([0, 1, 1, 0, 0], [1, 0, 0, 1, 1], [0, 1, 0, 1, 1], [1, 0, 1, 0, 0])
    assert shards.differencing([], 3) == [] and len(set(shards.differencing([5, 5, 5], 3))) == 3


@pytest.mark.parametrize("seed,n,parts", [(1, 1, 3), (2, 5, 2), (3, 40, 8), (4, 200, 5), (5, 64, 64)])
def test_differencing_equals_the_plain_method(seed, n, parts):
    rnd = random.Random(seed)
    weights = [rnd.randint(1, 30 if seed == 4 else 10 ** 6) for _ in range(n)]
    left = [(i, [(0, [])] * (parts - 1) + [(w, [i])]) for i, w in enumerate(weights)]
    seq = n
    while len(left) > 1:
        left.sort(key=lambda x: (x[1][0][0] - x[1][-1][0], x[0]))
        (_, a), (_, b) = left.pop(0), left.pop(0)
        both = [(x + y, p + q) for (x, p), (y, q) in zip(a, reversed(b))]
        left.append((seq, sorted(both, key=lambda x: x[0])))
        seq += 1
    expected = {i: k for k, (_, members) in enumerate(left[0][1]) for i in members}
    assert shards.differencing(weights, parts) == [expected[i] for i in range(n)]


def test_groups_are_bundled_on_spark_at_every_size(spark, monkeypatch):
    whole = []
    monkeypatch.setattr(shards, "HEAVY_SHARE", 64)  # or nearly all of so small a table would be heavy
    monkeypatch.setattr(shards, "differencing", lambda w, parts, f=shards.differencing: whole.append(len(w)) or f(w, parts))
    rows = [(i, f"text {i} " * (i % 50)) for i in range(2000)]
    out = shards.shard_documents(docs(spark, rows), 8).collect()
    assert whole[-1] < 1500  # heavy groups, one block of light ones, bundles
    sums = Counter()
    for r in out:
        sums[r["shard"]] += r["size"]
    assert len(out) == 2000 and max(sums.values()) - min(sums.values()) <= 2


@pytest.mark.parametrize("last,block", [(32_768, 8_192), (120, 40)])
def test_shards_hold_groups_and_balance(spark, monkeypatch, last, block):
    monkeypatch.setattr(shards, "LAST_GROUPS", last)
    monkeypatch.setattr(shards, "BLOCK_GROUPS", block)
    monkeypatch.setattr(shards, "HEAVY_SHARE", 64)
    monkeypatch.setattr(shards, "SLOT_ROWS", 30)
    rnd = random.Random(6)
    rows = [(i, "é" * rnd.randint(0, 400) + str(rnd.randrange(10 ** 6))) for i in range(900)]
    rows += [(1000 + i, "one text with many copies") for i in range(80)] + [(2000, None), (2001, None), (2002, ""), (7, rows[7][1]), (None, "n")]
    out = [r.asDict() for r in shards.shard_documents(docs(spark, rows), 8).collect()]
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == expected
    text = {i: t for i, t in rows}
    where = {}
    for r in out:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    for k in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(sum(r["shard"] == k for r in out)))
    sums = [sum(r["size"] for r in out if r["shard"] == k) for k in range(8)]
    assert max(sums) - min(sums) <= (2 if last > 1000 else 60)
    assert {(r["law"], r["grown_shard"]) for r in out} == {("bytes", None)}


def test_one_text_in_a_third_of_all_rows(spark):
    rows = [(i, "hot " * 50 if i % 3 == 0 else f"cold {i} " * 20) for i in range(300)]
    out = shards.shard_documents(docs(spark, rows), 8).collect()
    hot = {r["shard"] for r in out if r["doc_id"] % 3 == 0}
    assert len(hot) == 1
    rest = Counter()
    for r in out:
        if r["doc_id"] % 3:
            rest[r["shard"]] += r["size"]
    assert hot.isdisjoint(rest) and max(rest.values()) - min(rest.values()) <= 400


def test_no_documents_to_shard(spark):
    assert shards.shard_documents(docs(spark, []), 8).count() == 0


# -- top-k search

def best(vectors, every=50, k=5):
    out = set()
    for q, v in vectors.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), d) for d, w in vectors.items() if d != q and len(w) == len(v))
            out |= {(q, r + 1, d, -s) for r, (s, d) in enumerate(scored[:k])}
    return out


def quant(v):
    return [math.floor(256 * x) for x in v]


def searched(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, cell int")
    return {tuple(r) for r in covertree.top_k(df, **kw).select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("block", [4096, 60])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    monkeypatch.setattr(covertree, "QUERY_CHUNK", 7)
    rnd = np.random.default_rng(5)
    centers = rnd.normal(size=(6, 12))
    rows = []
    for i in range(500):
        v = centers[i % 6] * rnd.uniform(.2, 2) + rnd.normal(size=12) * rnd.choice([0, .05, .5])
        rows.append((i, [float(x) for x in (centers[0] if i % 9 == 0 else v)], "x", 1))
    good = {i: quant(v) for i, v, _, _ in rows}
    rows += [(600, None, "x", 1), (650, [1.0, None] * 6, "x", 1), (700, [float("nan")] * 12, "x", 1),
             (750, [float("inf")] * 12, "x", 1), (None, [1.0] * 12, "x", 1), (rows[50][0], rows[50][1], "y", 2),
             (800, [1.0, 2.0], "x", 1), (801, [3.0, -2.0], "x", 1), (850, [], "x", 1)]
    good |= {800: [256, 512], 801: [768, -512], 850: []}
    assert searched(spark, rows) == best(good)


def test_fewer_rows_than_k_and_large_numbers(spark):
    big = float(2 ** 30)
    rows = [(0, [big, 1.0], "", 0), (1, [big, 2.0], "", 0), (2, [-big, 0.5], "", 0)]
    small = [(i, [x / 4096 for x in v], a, b) for i, v, a, b in rows]
    assert searched(spark, small) == best({i: quant(v) for i, v, _, _ in small})
    assert searched(spark, []) == set()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-4, 4), min_size=2, max_size=2), min_size=1, max_size=90), st.integers(1, 4))
def test_dual_search_on_ties(points, k):
    x = np.array(points, np.int64)
    ids = np.arange(len(x)) * 3
    q = x[::4]
    rows, found, score = covertree.dual_search(q, ids[::4], np.full(len(q), -np.inf), x, ids, k)
    got = sorted(zip(rows.tolist(), score.tolist(), found.tolist()))
    expected = []
    for r, i in enumerate(ids[::4]):
        s = sorted((-int(q[r] @ y), int(j)) for j, y in zip(ids, x) if j != i)[:k]
        expected += [(r, -a, b) for a, b in s]
    assert got == sorted(expected)


def test_a_cover_tree_covers_and_separates():
    x = np.random.default_rng(2).normal(size=(400, 3))
    root, seen = covertree.build(x), []
    todo = [root]
    while todo:
        n = todo.pop()
        under, stack = [], [n]
        while stack:
            m = stack.pop()
            under += m.points.tolist()
            stack += m.kids
        assert (np.sqrt(((x[under] - x[n.center]) ** 2).sum(axis=1)) <= n.radius + 1e-9).all()
        if n.kids:
            half = 2.0 ** (math.ceil(math.log2(n.radius)) - 1)
            centers = [m.center for m in n.kids] + n.points.tolist()
            d = np.sqrt(((x[centers][:, None] - x[centers][None]) ** 2).sum(axis=2))
            assert (d[~np.eye(len(centers), dtype=bool)] > half).all()
        seen += n.points.tolist()
        todo += n.kids
    assert sorted(seen) == list(range(400))


# -- URL filter

def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def ruled(host, path):
    fit = [(len(h + p), h + p, k) for k, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "https://www.example.com", "http://com/", "x://net/es/://net/fr/",
       "http://a.net?x=/es/", "http://ÀB.example.com/en/\nq#z", "ftp://xcom/", "http://sub.www.example.com/en/1", "http://example.com/EN/",
       "http://user@h.com:80/p?a=1&b=2#f", "http://a.net/es", "http://a.net/es/"]


def test_rules_and_parts(spark):
    many = [f"http://h{i}.example.{['com', 'net', 'org'][i % 3]}/{['en', 'es', 'fr', 'de'][i % 4]}/{i}?p={i}" for i in range(240)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(ODD + many + many[:20])], "page_id long, url string, host string")
    rows = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert len(rows) == len(ODD + many) + 20
    for i, u in enumerate(ODD + many):
        host, path = parts(u)
        rule, kind = ruled(host, path)
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] in ("allow", "block") and (kind is None or r["verdict"] == kind)
        assert (r["score"] is None) == (kind is not None)
        if kind is None:
            assert r["verdict"] == ("block" if r["score"] > 0.5 else "allow")


def test_trees_learn_a_lexical_rule(spark):
    """Trained on one host's labelled URLs, the trees judge the unlabelled ones alike."""
    rnd = random.Random(3)
    rules = [("block", "bad.test", "/"), ("allow", "good.test", "/")]

    def url(kind, host):
        tail = "".join(rnd.choice("0123456789") for _ in range(14)) if kind else "".join(rnd.choice("abcdef") for _ in range(6))
        return f"http://{host}/{tail}" + ("?a=1&b=2&c=3" if kind else "")
    rows = [(0, url(1, "bad.test")) for _ in range(200)] + [(0, url(0, "good.test")) for _ in range(200)]
    rows += [(1, url(1, "other.test")) for _ in range(50)] + [(2, url(0, "other.test")) for _ in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = urls.judge(pages, rules=rules).where("rule is null").groupBy("page_id", "verdict").count().collect()
    right = {(r["page_id"], r["verdict"]): r["count"] for r in out}
    assert right.get((1, "block"), 0) >= 48 and right.get((2, "allow"), 0) >= 48


@pytest.mark.parametrize("urls_in,verdict", [([], None), (["http://org/"], "allow"), (["http://a.com/", "x://b.org/"], "allow"),
                                             (["http://a.net/es/", "x://b.org/"], "block")])
def test_labels_of_one_kind(spark, urls_in, verdict):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls_in)], "page_id long, url string")
    assert {r["verdict"] for r in urls.judge(pages).collect()} == ({verdict} if verdict else set())


def test_features(spark):
    df = spark.createDataFrame([("http://a-b.c1.com/x/y?p=1&q=2",), ("",)], "u string")
    row = urls.with_features(urls.with_parts(df, "u"), "u").collect()[0]
    u = row["u"]
    freq = [u.count(c) / len(u) for c in set(u)]
    assert row["f_entropy"] == pytest.approx(-sum(p * math.log2(p) for p in freq))
    assert (row["f_length"], row["f_depth"], row["f_params"], row["f_labels"], row["f_hyphens"]) == (len(u), 2, 2, 3, 1)
    assert row["f_digit_ratio"] == pytest.approx(3 / len(u)) and (row["_s1"], row["_s2"]) == ("com", "c1.com")


# -- WARC

PAGES = [(1, "http://a/\r\nWARC-Type: x", "é" * 60), (2, None, "é" * 60), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
         (6, "u", ""), (0, "z", "é" * 60), (0, "z", "é" * 60), (None, "n", "é" * 60), (8, "u", "x\r\n\r\ny\0" * 5000), (9, "u", "n" * 100),
         (10, "u", "n" * 100), (11, "u", "m" * 99), (12, "u", "m" * 99)]


def test_round_trip_equals_brute_force(spark):
    pages = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id long, url string, html string, digest string")
    out = warc.archive_round_trip(pages).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    expected = Counter()
    for i, u, h in PAGES:
        body = (h or "").encode()
        again = len(body) >= 100 and i != first[h or ""]  # a page without an id too
        expected[i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[h] if again else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == expected
    for r in out:
        assert r["verified"] and (r["payload"] is None) == (r["record_type"] == "revisit")
        assert r["payload"] is None or hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]
    assert {r["url"] for r in out if r["page_id"] == 1} == {"http://a/%0D%0AWARC-Type: x"}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


class Trickle(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(n, 7) if n and n > 0 else n)


def test_reader_takes_any_block_size():
    data = b"".join(warc.record(i, "u", b"p" * (i * 50)) for i in range(6))
    got = list(warc.read_records(Trickle(data + b"\0" * 20)))
    assert [len(r.payload) for r in got] == [0, 50, 100, 150, 200, 250] and all(r.verified for r in got)
    assert list(warc.read_records(io.BytesIO(b""))) == []


def _packed(head, block, tail=b"\r\n\r\n"):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + tail) + z.flush()


@pytest.mark.parametrize("data,message", [
    (warc.record(1, "u", b"abc" * 40)[:-9], "ends inside a gzip member"),
    (b"not gzip at all", "gzip"),
    (_packed(["HTTP/1.1 200"], b""), "WARC version"),
    (_packed(["WARC/1.1", "Content-Length: 9"], b"abc"), "shorter|longer"),
    (_packed(["WARC/1.1", "Content-Length: 2"], b"abc"), "longer"),
    (_packed(["WARC/1.1", "WARC-Type: response"], b""), "Content-Length"),
    (_packed(["WARC/1.1", "Content-Length: 3", "WARC-Block-Digest: sha256:" + "0" * 64], b"abc"), "wrong digest"),
    (_packed(["WARC/1.1", "Content-Length: 3", "WARC-Block-Digest: crc:1"], b"abc"), "not supported"),
])
def test_broken_archives_raise(data, message):
    with pytest.raises(warc.WarcError, match=message):
        list(warc.read_records(io.BytesIO(data)))


def test_wrong_digest_can_be_reported_instead():
    data = _packed(["WARC/1.1", "Content-Length: 3", "WARC-Block-Digest: sha256:" + "0" * 64], b"abc") + warc.record(2, None, b"ok")
    assert [r.verified for r in warc.read_records(io.BytesIO(data), strict=False)] == [False, True]


# -- mixing

def test_exponents_meet_their_targets():
    tokens = [1000, 300, 50, 7, 0]
    for target in (0.3, 0.9, 1.2):
        a = mixing.exponent_for(tokens, target_entropy=target)
        assert mixing.entropy(mixing.weights_at(tokens, a)) == pytest.approx(target, abs=1e-6)
    for most in (1.0, 1.5, 4.0):
        a = mixing.exponent_for(tokens, max_repeats=most)
        r = mixing.ratios(tokens, mixing.weights_at(tokens, a), None)
        assert max(r) == pytest.approx(most) and min(r) == pytest.approx(1.0)
    assert mixing.exponent_for([], max_repeats=2.0) == 0.0
    with pytest.raises(ValueError):
        mixing.exponent_for(tokens)


def corpus(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randint(0, 40), "big" if i % 3 == 0 else [None, "a", "b", ""][i % 4], 7) for i in range(400)]
    rows += [(5, rows[5][1], rows[5][2], 7), (None, "x y z", "a", 7), (401, None, "none", 7), (402, "", "none", 7)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, tokens int")


@pytest.mark.parametrize("kw", [{}, {"max_repeats": 3.3}, {"target_entropy": 1.3, "max_repeats": None},
                                {"max_repeats": 1.0, "budget": 900.0}, {"target_entropy": 0.7, "max_repeats": None, "budget": 5000.0}])
def test_mix_is_whole_permutations_and_one_prefix(spark, kw):
    rows, df = corpus(spark)
    out = [r.asDict() for r in mixing.mix_schedule(df, block_tokens=500, **kw).collect()]
    taken = mixing.mix_documents(df, **kw)
    assert taken.columns == df.columns
    assert Counter((r["doc_id"], r["source"]) for r in out) == Counter((r["doc_id"], r["source"]) for r in taken.collect())
    have, docs_of = Counter(), Counter()
    for i, t, s, _ in rows:
        have[s] += len((t or "").split())
        docs_of[s] += 1
    weights, ratio = {}, {}
    for r in out:
        weights[r["source"]], ratio[r["source"]] = r["weight"], r["ratio"]
    if len(weights) == len(have):
        assert sum(weights.values()) == pytest.approx(1.0)
        if kw.get("target_entropy"):
            assert mixing.entropy(weights.values()) == pytest.approx(kw["target_entropy"], abs=1e-6)
    for s in ratio:
        mine = [r for r in out if r["source"] == s]
        whole = int(ratio[s] + 1e-9)
        copies = Counter(r["copy"] for r in mine)
        assert all(copies[c] == docs_of[s] for c in range(whole))
        assert set(copies) <= set(range(whole + 1))
        rest = (ratio[s] - whole) * have[s]
        last = [r for r in mine if r["copy"] == whole]
        assert sum(r["n_tokens"] for r in last) <= rest + 1e-6
        if len(last) < docs_of[s] and rest > 1:
            assert sum(r["n_tokens"] for r in last) > rest - 42 * 2  # the next document did not fit
        at = 0
        for r in sorted(mine, key=lambda r: (r["start_token"], r["n_tokens"])):
            assert r["start_token"] == at or r["start_token"] % max(have[s], 1) == 0
            at = r["start_token"] + r["n_tokens"]
            assert r["block"] == (int(r["start_token"] / (r["weight"] * 500)) if r["weight"] else 0)
    if not kw:
        assert Counter((r["doc_id"]) for r in out if r["copy"] == 0) == Counter(i for i, *_ in rows)
    orders = [[r["doc_id"] for r in sorted((r for r in out if r["source"] == "a" and r["copy"] == c), key=lambda r: r["start_token"])]
              for c in (0, 1)]
    assert not orders[1] or orders[0][:len(orders[1])] != orders[1]


def test_no_documents_to_mix(spark):
    _, df = corpus(spark)
    assert mixing.mix_schedule(df.limit(0)).count() == 0 and mixing.mix_documents(df.limit(0)).count() == 0


# -- components

def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (301, 300), (300, 301)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_rates_count_all_labelled_urls(spark, monkeypatch):
    seen, real = [], urls._suffix_rates

    def spy(rows, suffix, name):
        seen.append(rows.count())
        return real(rows, suffix, name)

    monkeypatch.setattr(urls, "_suffix_rates", spy)
    rows = [(f"http://h{i}.{kind}/p{i}",) for i in range(60) for kind in ("good", "bad", "other")]
    rules = [("allow", "good", "/"), ("block", "bad", "/")]
    judged = urls.judge(spark.createDataFrame(rows, "url string"), rules=rules, max_train=40)
    assert seen == [120, 120] and judged.count() == 180


def test_routes_on_the_driver_are_cell_to_cell(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 16)
    monkeypatch.setattr(covertree, "MAX_CELLS", 2)
    seen, real = {}, covertree.materialize

    def spy(df, name, *args, **kw):
        if name == "routes":
            seen[name] = df.count()
        return real(df, name, *args, **kw)

    monkeypatch.setattr(covertree, "materialize", spy)
    rows = [(i, [float((i * 7 + j * 3) % 11) for j in range(4)]) for i in range(400)]
    got = covertree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=10).count()
    assert got == 40 * covertree.K and 0 < seen["routes"] <= 4
