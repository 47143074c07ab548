"""Quality rules, SimHash, suffix dedup, BPE and LM scoring against brute force."""

import hashlib
import math
import random
import struct
from collections import Counter, defaultdict
from contextlib import contextmanager

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mutualis.llm import bpe, pst, repetition, simhash, suffixdedup, textcore
from mutualis.session import scratch_scope

SCHEMA = "doc_id long, text string, kept string, fp string, spans int, row int"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "k", "f", 1, 2) for i, t in zip(ids, texts)], SCHEMA)


@contextmanager
def settings_of(spark, values):
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# -- words and hashes

@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x0c\rabZé漢\x1c ", max_size=30), max_size=8))
def test_spans_are_the_words(texts):
    import pyarrow as pa
    h = textcore.Hasher()
    got = []
    for _, _, data, bounds in textcore.text_chunks(pa.array(texts, pa.string()), limit=10):
        s, e, row, _ = h.tokens(data, bounds)
        for r in range(len(bounds) - 1):
            got.append([bytes(data[a:b]) for a, b, x in zip(s, e, row) if x == r])
    assert got == [t.encode().split() for t in texts]


def test_lookup_finds_what_is_there():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    found = textcore.Lookup(keys[::2]).find(keys)
    assert (found[::2] == np.arange(len(keys[::2]))).all() and (found[1::2] == -1).all()
    assert (textcore.Lookup(keys[:0]).find(keys) == -1).all()


# -- quality rules

def test_measures_equal_brute_force(spark):
    texts = brute.awkward_texts()
    got = {r["doc_id"]: r.asDict() for r in repetition.assess(frame(spark, texts), keep=["doc_id"]).collect()}
    for i, t in enumerate(texts):
        if len(brute.words(t)) > 1000:
            continue
        for name, value in brute.measures(t).items():
            assert got[i][name] == value, (i, name)
        assert got[i]["kept"] == brute.kept(t)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4), st.integers(1, 5))
def test_lcp_intervals_on_few_words(docs, size):
    import pyarrow as pa
    texts = [" ".join(d) for d in docs]
    (_, _, data, bounds), = textcore.text_chunks(pa.array(texts))
    m = repetition.measure(textcore.Hasher(), data, bounds, size)
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in m.items()} == brute.measures(t, size)


def test_keep_good_keeps_rows_and_columns(spark):
    texts = brute.awkward_texts()
    docs = frame(spark, texts)
    out = repetition.keep_good(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [i for i, t in enumerate(texts) if brute.kept(t)]
    assert repetition.keep_good(docs.limit(0)).count() == 0


# -- SimHash

def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(4)
    texts = brute.awkward_texts()
    base = [f"v{i}" for i in range(400)]
    for _ in range(60):
        w = list(base)
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = f"n{rnd.randrange(1000)}"
        texts.append(" ".join(w))
    fps = [brute.fingerprint(t) for t in texts]
    low = brute.groups(fps)
    assert len(set(low)) < len(texts) - 20
    docs = frame(spark, texts)
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f, c) for i, (f, c) in enumerate(zip(fps, low))}
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(low))


def test_near_duplicates_without_ids_and_repeated_rows(spark):
    docs = frame(spark, ["one text of words", "one text of words", "other kind entirely", None, "", "other kind entirely"],
                 [None, 5, None, 7, 7, None])
    rows = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert rows == {(None, 5), (5, 5), (None, None), (7, 7)}
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.keep_one(docs).collect())
    assert [k[0] for k in kept] == [0, 5, 7] and len(kept) == 3
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bucket", [2, 512])
def test_pairs_lose_no_link(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    rnd = np.random.default_rng(3)
    seeds = rnd.integers(0, 1 << 63, 40)
    fps = {int(s) for s in seeds}
    for s in seeds[:12]:  # clusters in which everything is within a few bits
        for _ in range(25):
            x = int(s)
            for b in rnd.integers(0, 63, rnd.integers(1, 4)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    from mutualis.llm.components import components
    got = {r["node"]: r["component"] for r in components(
        simhash.pairs(spark.createDataFrame([(f,) for f in fps], "fp long"))).collect()}
    low = brute.groups(fps)
    assert [got.get(f, f) for f in fps] == [fps[i] for i in low]


# -- suffix dedup

def _spans(found):
    return {r["doc_id"]: ({w for s in r["spans"] if s["later"] for w in range(s["start"], s["end"])},
                          {w for s in r["spans"] if not s["later"] for w in range(s["start"], s["end"])}) for r in found}


def _passages(seed, n, vocabulary):
    rnd = random.Random(seed)
    shared = [[rnd.choice(vocabulary) for _ in range(rnd.randint(10, 60))] for _ in range(6)]
    texts = []
    for _ in range(n):
        w = []
        for _ in range(rnd.randint(0, 4)):
            w += [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))]
            if rnd.random() < .6:
                p = rnd.choice(shared)
                a = rnd.randrange(len(p))
                w += p[a:a + rnd.randint(5, 60)]
        texts.append(rnd.choice([" ", "\n", " \t"]).join(w))
    return texts


@pytest.mark.parametrize("size,words", [(12, 400), (20, 3), (5, 8), (1, 30)])
def test_repeated_spans_equal_brute_force(spark, size, words):
    texts = _passages(size, 40, [f"v{i}" for i in range(words)]) + [None, "", "one"]
    found = _spans(suffixdedup.repeated_spans(frame(spark, texts), min_words=size).collect())
    expected = {i: s for i, s in brute.repeats(list(enumerate(texts)), size).items() if s[0] or s[1]}
    assert found == expected


@pytest.mark.parametrize("partitions,batch", [(1, 10_000), (7, 3), (40, 1)])
def test_neighbours_in_the_sorted_suffixes(spark, partitions, batch):
    rnd = random.Random(partitions)
    rows = [(5 if rnd.random() < 0.4 else rnd.randrange(400), rnd.randrange(30), rnd.choice([None, 1, 2, 3]), (1, 2), i, i)
            for i in range(500)]
    rows.append((-9, 1, 1, (1, 2), 0, 0))
    table = spark.createDataFrame(rows, f"prefix long, whole long, doc_id long, t {suffixdedup.TEXT_NAME}, lo int, hi int")
    with settings_of(spark, {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false",
                             "spark.sql.execution.arrow.maxRecordsPerBatch": batch}):
        with scratch_scope(spark) as scope:
            array = suffixdedup._array(table)
            assert array.where("edge").count() <= 2 * partitions
            got = sorted((r["whole"], r["p"]["lo"]) for r in suffixdedup._neighbours(table, scope).collect())
            assert suffixdedup._neighbours(table.limit(0), scope).count() == 0
    times = Counter(r[0] for r in rows)
    assert got == sorted((r[1], r[4]) for r in rows if times[r[0]] > 1)


def test_drop_repeats_cuts_words_only(spark):
    texts = brute.awkward_texts()
    docs = frame(spark, texts).withColumn("n_chars", F.lit(-1).cast("long"))
    out = suffixdedup.drop_repeats(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for i, (later, _) in brute.repeats(list(enumerate(texts)), 50).items():
        w = brute.words(texts[i])
        left = [x for j, x in enumerate(w) if j not in later]
        if later and not left:
            assert i not in got
        elif later:
            assert brute.words(got[i]["text"]) == left and got[i]["n_chars"] == len(got[i]["text"])
        else:
            assert got[i]["text"] == texts[i] and got[i]["n_chars"] == -1
    assert suffixdedup.drop_repeats(docs.limit(0)).count() == 0


def test_rows_that_repeat_id_and_text_are_one_document(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [base, base, base + " z", base], [3, 3, 9, None])
    found = _spans(suffixdedup.repeated_spans(docs).collect())
    assert found == {None: (set(), set(range(60))), 3: (set(range(60)), set()), 9: (set(range(60)), set())}


# -- BPE

@pytest.fixture(scope="module")
def tables():
    return bpe.load_tables(bpe.default_tokenizer())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_tokenizer())


SPECIAL = ["It's I'LL we'd <|endoftext|>x<|startoftext|> Σας ΣΑΣ İstanbul", "a\x1cb c\x85d　e f",
           "  lead 12345 !!?? '''s", "é Ᲊᲊ ՘࢏ ῿퟿", "<|endoftext|>"]


def test_documents_equal_the_library(spark, library):
    texts = brute.awkward_texts() + SPECIAL
    rows = {r["doc_id"]: r for r in bpe.encode_documents(frame(spark, texts), keep=["doc_id", "kept"]).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        r = rows[i]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["kept"] == "k"
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(frame(spark, [])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet=st.sampled_from("abeinrstxyzéß"), min_size=1, max_size=900), st.integers(1, 64))
def test_transducer_emits_only_final_tokens(tables, library, text, block):
    encoder = bpe.Encoder(tables)
    data = text.encode()
    step, out = bpe.Transducer(encoder.t, block), []
    for a in range(0, len(data), 7):
        out += step.push(data[a:a + 7])
        assert len(step.buffer) <= tables["lookahead"] + 3 * block + 64
    assert out + step.close() == library.encode(text, add_special_tokens=False).ids


def test_lookahead_on_a_chain():
    # cd before bc before ab: whether ab merges depends on the letter after c.
    merges = [(2, 3, 4), (1, 2, 5), (0, 1, 6)]
    assert bpe.lookahead(merges, {0: 1, 1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2}) == 4


def test_byte_decoder_is_incremental():
    alphabet = bpe.byte_alphabet()
    t = {"tokens": alphabet, "decoder": "ByteLevel"}
    data = "aé漢😀".encode() + b"\xff\xe6\xbc"
    step = bpe.Decoder(t)
    assert "".join([step.feed([b]) for b in data] + [step.close()]) == data.decode("utf-8", "replace")


# -- LM scoring

def _corpus():
    rnd = random.Random(8)
    texts = []
    for _ in range(300):
        w, x = [], rnd.choice("abcdef")
        for _ in range(rnd.randint(0, 40)):
            x = {"a": "b", "b": "c"}.get(x, rnd.choice("abcdefgh")) if rnd.random() < .8 else f"rare{rnd.randrange(3000)}"
            w.append(x)
        texts.append(" ".join(w))
    return texts + [None, "", "A B  c", "unseen unseen"]


def test_base_scores_equal_brute_force(spark):
    texts = _corpus()
    ids = [*range(len(texts) - 1), None]
    rows = {r["doc_id"]: r for r in pst.score_documents(frame(spark, texts, ids)).collect()}
    for i, held, n, known, total, base in brute.scores(list(zip(ids, texts))):
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(pst, "HEAD_SHARE", 0.02)
    test_base_scores_equal_brute_force(spark)


def test_tree_beats_the_root(spark):
    rows = [r for r in pst.score_documents(frame(spark, _corpus()), share=1e-3, divergence=5.0).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 10


def test_no_training_tokens(spark):
    held = [i for i in range(200) if brute.scores([(i, "")])[0][1]][:2]
    rows = pst.score_documents(frame(spark, ["a b", None], held)).collect()
    assert [(r["train_tokens"], r["base_score"], r["score"]) for r in rows] == [(0, 0.0, 0.0)] * 2
    assert pst.score_documents(frame(spark, [])).count() == 0


def _tree_scores(docs, depth, divergence, least=2):
    """Brute-force suffix tree: every context of up to depth words, states by the divergence test."""
    tokens = [(i, held, (t or "").lower().split() + [None]) for (i, t), (_, held, *_) in zip(docs, brute.scores(docs))]
    after, total = defaultdict(Counter), Counter()
    for _, held, own in tokens:
        if not held:
            total.update(own)
            for p in range(len(own)):
                for d in range(1, min(depth, p) + 1):
                    after[tuple(own[p - d:p])][own[p]] += 1
    n, v, states = sum(total.values()), len(total), {}

    def prob(context, a):
        for k in range(len(context)):
            s = states.get(context[k:])
            if s is not None:
                return s[0].get(a, 0.0) + s[1] * prob(context[k + 1:], a)
        return (total[a] + .1) / (n + .1 * (v + 1))

    for s in sorted(after, key=len):
        c, kept = sum(after[s].values()), {a: m for a, m in after[s].items() if m >= least}
        if kept:
            q, rest = {a: prob(s[1:], a) for a in kept}, c - sum(kept.values())
            gain = sum(m * math.log(m / c / q[a]) for a, m in kept.items())
            gain += rest * math.log(rest / c / max(1 - sum(q.values()), 1e-12)) if rest else 0
            if gain >= divergence:
                states[s] = ({a: m / (c + 2) for a, m in kept.items()}, 1 - sum(kept.values()) / (c + 2))
    return {i: sum(math.log10(prob(tuple(own[max(0, p - depth):p]), a)) for p, a in enumerate(own))
            for i, _, own in tokens}, states


@pytest.mark.parametrize("head", [pst.HEAD_FACTORS, 0])
def test_tree_scores_equal_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(pst, "HEAD_FACTORS", head)
    docs = list(enumerate(_corpus()))
    expected, states = _tree_scores(docs, 2, 5.0)
    assert {len(s) for s in states} == {1, 2}
    rows = pst.score_documents(frame(spark, [t for _, t in docs]), divergence=5.0, depth=2).collect()
    assert {r["doc_id"]: r["score"] for r in rows} == pytest.approx(expected, rel=1e-9)


def test_states_do_not_depend_on_the_size_of_the_corpus(spark):
    """A pair seen a few times is a state, however small its share of the tokens is."""
    texts = ["left right"] * 4 + [" ".join(f"w{(i * j) % 1009}" for j in range(400)) for i in range(1500)]
    rows = {r["doc_id"]: r for r in pst.score_documents(frame(spark, texts)).collect()}
    assert rows[0]["train_tokens"] > 500_000
    assert rows[0]["score"] > rows[0]["base_score"] + 4


def test_contexts_are_as_long_as_the_text_needs(spark):
    """The word after the passage is told by the one 6 words before it."""
    rnd = random.Random(3)
    texts = [" ".join([*(f"n{rnd.randrange(400)}" for _ in range(20)), f"key{k}", "a b c d e", f"end{k}"])
             for _ in range(120) for k in range(3)]
    docs = list(enumerate(texts))
    expected, states = _tree_scores(docs, 12, 20.0)
    assert {len(s) for s in states} >= {1, 6}
    rows = pst.score_documents(frame(spark, texts)).collect()
    assert {r["doc_id"]: r["score"] for r in rows} == pytest.approx(expected, rel=1e-9)
