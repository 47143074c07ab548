"""MinHash near-duplicates, phrase collocations and conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mutualis.llm import collocations, conversations, minhash

# -- MinHash


def shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, min(len(w), 1)))}


def linked_groups(rows, percent=85):
    """(id, set size, component) of (id, text) rows, all pairs compared."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                up[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted(((d, len(s), low.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(seed=3):
    rng = random.Random(seed)
    texts = list(brute.awkward_texts()) + ["one two", "ONE two", "one two three four five", "one two three four six"]
    for size in (40, 150, 400):
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, size // 25))):
                words[rng.randrange(size)] = f"x{rng.randrange(500)}"
            texts.append(" ".join(words))
        for part in (0.1, 0.3, 0.6):  # families that share most of the text, not enough of it
            texts.append(" ".join(base[int(size * part):] + [f"y{rng.randrange(9999)}" for _ in range(int(size * part))]))
    return texts


@pytest.mark.parametrize("block", [256, 2])
def test_linked_groups(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = near_copies()
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[5]), (None, "of its own kind here now"), (7, texts[5]), (7, texts[5])]
    df = spark.createDataFrame([(d, t, "n", 1, 2) for d, t in rows], "doc_id long, text string, node string, n int, label int")
    got = minhash.near_duplicates(df.repartition(3)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == linked_groups(rows)
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in got)


def test_minhash_without_documents(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_coordinate_is_filled():
    rng = np.random.default_rng(5)
    sizes = np.array([1, 2, 3, 10, 200, 3000, 0])
    s = minhash.sketch(rng.integers(1, 1 << 63, sizes.sum()).astype(np.uint64), sizes)
    assert (s[:-1] != 0).all() and (s[-1] == 0).all()


def test_agreement_is_similarity():
    rng = np.random.default_rng(6)
    shares = []
    for n in (6, 40, 1000):
        for _ in range(30):
            keys = np.unique(rng.integers(1, 1 << 63, 2 * n).astype(np.uint64))
            both = int(len(keys) * 0.7)
            one = minhash.sketch(keys[:both], np.array([both]))
            all_ = minhash.sketch(keys, np.array([len(keys)]))
            shares.append(((one == all_).mean(), both / len(keys)))
    got, true = np.array(shares).T
    assert abs(got.mean() - true.mean()) < 0.02 and np.abs(got - true).max() < 0.25


# -- collocations

def phrases(rows, least, limit, absorb=80):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, 5):
                f[lang or "und"].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, count in f.items():
        often = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        found = []
        for p, a in often.items():
            cuts = [(2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(100 * b >= absorb * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in often.items() if len(q) > len(p))
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def phrase_rows():
    rng = random.Random(11)
    rows = [(rng.choice(["en", None, "und", "de"]), "".join(
        rng.choice(["a", "b", "cc", "Dd", "é"]) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ", " "]) for _ in range(rng.randrange(60))))
        for _ in range(60)]
    return rows + [("en", None), ("en", ""), (None, " .,! "), ("en", "a b cc Dd " * 200), ("en", "z" * 20000 + " a b"), rows[0], rows[0]]


@pytest.mark.parametrize("hot_share", [1.0, 0.05, 1e-9])
@pytest.mark.parametrize("least, limit", [(3, 2000), (2, 5)])
def test_phrases(spark, monkeypatch, hot_share, least, limit):
    monkeypatch.setattr(collocations, "RUN", 64)
    monkeypatch.setattr(collocations, "HELD", 500)
    rows = phrase_rows()
    df = spark.createDataFrame([(x, t, "w", 1) for x, t in rows], "lang string, text string, word string, n int").repartition(3)
    got = collocations.collocations(df, least=least, limit=limit, hot_share=hot_share).collect()
    assert sorted(map(tuple, got)) == phrases(rows, least, limit)


def test_no_phrases(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), *[st.integers(0, 3)] * 3, st.integers(1, 3)), min_size=1, max_size=60), st.integers(1, 8))
def test_three_way_quicksort_counts(rows, least):
    rows = sorted((a, *[x if all((b, c, d)[:i + 1]) else 0 for i, x in enumerate((b, c, d))], n) for a, b, c, d, n in rows)
    words = [np.array([r[i] for r in rows], np.uint64) for i in range(4)]
    starts = np.flatnonzero(np.append(True, words[0][1:] != words[0][:-1]))
    got = {}
    for at, size, count in collocations.sorted_counts(words, np.array([r[4] for r in rows]), starts, np.ones(len(starts)), least):
        got.update({tuple(int(w[i]) for w in words[:k]): c for i, k, c in zip(at, size, count)})
    want = Counter()
    for *w, n in rows:
        for k in range(2, 5):
            if w[k - 1]:
                want[tuple(w[:k])] += n
    assert got == {p: c for p, c in want.items() if c >= least}


# -- conversations

def repaired(rows):
    """Fields of one conversation's rows (turn, role, text), edit lists as whole strings."""
    blank = re.compile(r"[^\x20\x09-\x0D]")
    seen, marks = set(), []
    for _, role, text in rows:
        chars = blank.findall(text)
        marks.append("b" if not chars else "d" if (role, text) in seen else "t" if chars[-1] not in ".!?" else "")
        seen.add((role, text))
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}
    far = (10 ** 9, "", ())

    def inserted(best):
        for _ in range(4):
            best = {s: min([best[s]] + [(best[x][0] + 3, "I" + best[x][1], (f"{conversations.NAMES[x]}:",) + best[x][2])
                                        for x in nexts[s] if x != "s"], key=lambda w: w[:2]) for s in best}
        return best

    best = inserted({"": (0, "", ()), "s": far, "u": far, "a": (0, "", ())})
    for (_, role, text), mark in zip(reversed(rows), reversed(marks)):
        now = {}
        for s in best:
            c, x, lines = best[s]
            ways = [(c + 4, "D" + x, lines)]
            for to in nexts[s] if mark not in ("b", "d") else "":
                c, x, lines = best[to]
                c += 3 * (mark == "t")
                if role[:1] == to:
                    ways.append((c, "K" + x, (f"{role}:{text}",) + lines))
                if to != "s":
                    ways.append((c + 3, "R" + x, (f"{conversations.NAMES[to]}:{text}",) + lines))
            now[s] = min(ways, key=lambda w: w[:2])
        best = inserted(now)
    cost, audit, lines = best[""]
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(marks.count(m) for m in "bdt"),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        sp = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{sp[0]}:{sp[1]}".encode()) % 20
        role, text = sp[2], sp[3]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def conversation_rows():
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Fine.", "Fine", "Is it?", " \t", "", None, "Yes! ", "so\n", "漢。", "x" * 5000 + "."]
    rows = [(c, rng.choice([None, *range(9)]), rng.choices(roles, [6, 6, 2, 1, 1, 1])[0], rng.choice(texts))
            for c in [*range(60), None] for _ in range(rng.randrange(1, 14))]
    return rows + [rows[0], rows[0], (99, None, "user", "a."), (98, 5, None, None)]


@pytest.mark.parametrize("long_rows, segment", [(4096, 4096), (0, 1), (3, 2)])
def test_conversations(spark, long_rows, segment):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, seg int")
    got = conversations.audit(df, conversations.damage(df), long_rows, segment).collect()
    want, left = [], defaultdict(list)
    for conv, *row in damaged(rows):
        left[conv].append(tuple(row))
    for conv in {r[0] for r in rows}:
        mine = sorted(left[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        want.append((conv, *repaired(mine)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.audit(df, conversations.damage(df)).count() == 0


def test_undamaged_conversation_is_kept(spark):
    df = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes.")],
                               "conv_id long, turn long, role string, text string")
    row = conversations.audit(df).collect()[0]
    assert (row["cost"], row["audit"]) == (0, "KKK")
    assert row["repaired_sha256"] == hashlib.sha256(b"system:Be kind.\nuser:Hi?\nassistant:Yes.").hexdigest()


@pytest.mark.parametrize("modulus", [conversations._MOD, 7])
def test_lists_compare_as_strings(monkeypatch, modulus):
    """Also where nearly all hashes collide."""
    monkeypatch.setattr(conversations, "_MOD", modulus)
    rng = random.Random(1)
    lists, made = conversations.Lists(), [(0, "")]
    for _ in range(600):
        node, text = made[rng.randrange(max(0, len(made) - 40), len(made))]
        letter = rng.choice("DK")
        made.append((lists.add(letter, node), letter + text))
    for _ in range(4000):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        assert lists.less(a, b) == (x < y), (x, y)
        assert lists.text(a) == x


# -- documents that a short hash takes for one another

@pytest.fixture(scope="module")
def alike(spark):
    """A short and a long text, unrelated, that Spark's 32-bit hash takes for one another."""
    from pyspark.sql import functions as F

    def texts(kind, n):
        rest = " ".join(f"{kind}{i}" for i in range(n - 1))
        return spark.range(120_000).select(F.concat(F.col("id").cast("string"), F.lit(kind + " " + rest)).alias(kind)).withColumn(
            "h", F.hash(kind))
    met = texts("short", 60).join(texts("long", 206), "h").select("short", "long").first()
    assert met is not None
    return met["short"], met["long"]


@pytest.mark.parametrize("ids", [(None, None), (7, 7)])
def test_texts_of_equal_short_hash_are_two_documents(spark, alike, ids):
    from mutualis.llm import simhash, suffixdedup
    rows = list(zip(ids, alike))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["text"] for r in simhash.keep_one(df).collect()} == set(alike)
    assert simhash.keep_one(df.union(df)).count() == 2
    # The long one repeats under another id: the short one must stay whole.
    more = spark.createDataFrame([*rows, (9, alike[1]), (9, alike[1]), (5, alike[1]), (5, alike[1])], "doc_id long, text string")
    left = suffixdedup.drop_repeats(more).collect()
    assert [r["text"] for r in left if r["text"] == alike[0]] == [alike[0]]
    # Repeated rows are one place: both rows of the first document stay.
    assert sum(r["text"] == alike[1] for r in left) == (1 if ids[0] is None else 2)


# -- the mix's rows in the order of its blocks

def test_mixed_rows_lie_block_by_block(spark):
    from pyspark.sql import functions as F

    from mutualis.llm import mixing
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("w"), (F.col("id") % 17 + 1).cast("int"))).alias("text"),
        F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").alias("source"))
    plan = mixing.mix_schedule(docs, block_tokens=200).collect()
    blocks = defaultdict(list)
    for r in plan:
        blocks[r["doc_id"]].append(r["block"])
    order = [r["doc_id"] for r in mixing.mix_documents(docs, block_tokens=200).collect()]
    assert Counter(order) == Counter(r["doc_id"] for r in plan)
    sizes = Counter(r["block"] for r in plan)
    at = 0
    for b in sorted(sizes):
        here = order[at:at + sizes[b]]
        at += sizes[b]
        assert Counter(here) == Counter(r["doc_id"] for r in plan if r["block"] == b)
    assert len(sizes) > 5


def test_broadcasts_hold_plain_data_only(spark):
    """Workers that cannot import this package can read what op10 sends them."""
    import pickle
    import subprocess
    import sys

    from mutualis.llm import pst
    levels = [{"pair": pst.BitSet(12, np.arange(64, dtype=np.uint64))}]
    data = pickle.dumps((pst._plain(levels), None))
    code = "import sys, pickle; print(pickle.load(sys.stdin.buffer)[0][0]['pair'][0])"
    res = subprocess.run([sys.executable, "-c", code], input=data, capture_output=True, cwd="/", timeout=60)
    assert res.stdout.strip() == b"12", res.stderr
    assert (pst._made(pst._plain(levels))[0]["pair"].words == levels[0]["pair"].words).all()


def test_two_words_hash_like_their_window():
    from mutualis.llm import pst, textcore
    hasher = textcore.Hasher()
    data = np.frombuffer(b"Aa bb cc bb aa", np.uint8)
    keys, _ = pst.sequences(hasher, data, np.array([0, len(data)]))
    assert (hasher.pairs(keys[:-1], keys[1:]) == hasher.grams(hasher.word_prefix(keys), np.arange(5), 2)).all()


def test_words_and_contexts_leave_the_text_packed(spark):
    """op10: no row for each word, context or pair goes through a shuffle."""
    from mutualis.llm import pst
    from mutualis.session import scratch_scope
    texts = [(" ".join(f"w{(i * j) % 1009}" for j in range(400)),) for i in range(200)] + [("left right",)] * 2
    made = []

    class Train:  # notes what the text pass makes
        def __init__(self, frame):
            self.frame, self.sparkSession = frame, frame.sparkSession

        def mapInArrow(self, run, schema):
            out = self.frame.mapInArrow(run, schema)
            made.append(out.count())
            return out

    with scratch_scope(spark):
        vocab, model, twice = pst.vocabulary(Train(spark.createDataFrame(texts, "text string").coalesce(1)))
        assert model["total"] == 200 * 401 + 6 and vocab.count() == model["different"]
    assert made[0] <= 3 << pst._part_bits(spark)
    left, right = (pst.sequences(pst.Hasher(), np.frombuffer(b"left right", np.uint8), np.array([0, 10]))[0][i:i + 1] for i in (0, 1))
    assert twice.has(pst.Hasher().pairs(left, right)).all()
