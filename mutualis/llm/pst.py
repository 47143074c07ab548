"""Language-model scoring with a probabilistic suffix tree over words.

Training documents give token counts; a document's tokens are its words (A-Z lower-cased) and one
end token. Contexts are the words before a token; they are counted level by level (one word to the
left a level) over all training tokens, and the tokens that follow one LEAST times or more are
gathered in written tables keyed by hash. A context becomes a state if its distribution of the
gathered tokens and of all others together diverges from that of its longest shorter state: count x
KL divergence of at least ``divergence`` nats.

A context is extended while some longer context could pass that test. An extension's counts are
parts m of its suffix's counts n, and sum m log(m / (M q)) over parts is at most sum n log(1/q), and
at most z + sum n max(0, log(n / (z q)) - 1) for any z > 0; a context with either below the
divergence has no state among its extensions, so nothing is lost by leaving it (``_level``). Where the
contexts to extend hold few of the tokens, several levels are counted in one pass over the text, as
many as keep the positions looked at below one for BATCH training tokens. The contexts that extend one context need no
others then, so these levels are tested in a task for each share of the contexts (``_levels``).

Keys leave the text in packed arrays (``_pack``), dealt by the first bits of a hash; keys and counts lie there byte by
byte, first bytes first, as those of sorted keys and small counts compress. Pairs of neighbours and, one
pass later, three words in a row are first sought by a part of their hashes (``_seen``): only those found twice are
counted. A word's count is that of the context of one word, a pair's that of the context of two.

Smoothing: a state gives a gathered token n / (c + KAPPA) (n its count there, c the state's) and
leaves the rest of its mass to the shorter state's distribution; the root is the add-0.1 unigram
distribution with one unseen token. Every distribution sums to one. A token is scored in the state
of the longest suffix of the words before it: the root's probability times, for every state on the
way, the mass it leaves and, for a token gathered there, what it adds. These factors are a written
table too; its most frequent entries (HEAD_FACTORS) are looked up where the text is, all others are
joined exactly. Where to look is told by bit sets of bounded size, which may say yes wrongly: the
joins are exact. A large corpus is scored in ROUNDS, by a hash of the id, as what is joined late would lie on disk at once.

Words are identified by a 64-bit hash, contexts and tokens after them likewise. Words that make up at
least HEAD_SHARE of the training tokens (at most 1/HEAD_SHARE of them) are scored where the text is;
the others' counts are joined from the vocabulary table.

Null text is empty: one token, the end. A null id is read as an empty text and so is held out.
Repeated rows are scored one by one. Without any training token every probability is 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, current_scope, materialize, scratch_scope, shuffles_dropped
from .textcore import Hasher, Lookup, mix, text_chunks

LEAST = 2           # least count of a token after a context
DEPTH = 64          # words of a context, at most
HEAD_FACTORS = 1 << 20  # factors that are broadcast, at most
BATCH = 2           # levels are counted together while that gives at most one position for so many tokens
SET_BITS = 27       # a bit set has 2^27 bits at most
HEAD_SHARE = 5e-7   # least share of a word that is broadcast
DIVERGENCE = 20.0   # nats
KAPPA = 2.0         # smoothing mass of a state
ADD = 0.1
_LEFT = np.uint64(0x1EF7 << 40)  # tells the key of a context from that of the same words as context and token
END = 0x5EED0F7E47      # the end token's key; words' keys are hashes
FLUSH = 1 << 21     # keys held in a task before they are added up
MOST = 1 << 20      # different keys held in a task before they are sent on
ROUNDS = 4          # in which documents are scored, at most; each sends the table of late factors again
ROUND_TOKENS = 1 << 25  # training tokens for each of them


def add_up(keys: np.ndarray, counts: np.ndarray, *columns: np.ndarray):
    """Sorted different keys, their total counts and their columns."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts, *(x[order[at]] for x in columns)


class Tally:
    """Counts 64-bit keys with columns that depend on the key; yields partial rows ``(keys, counts,
    *columns)``, keys sorted, so that memory stays bounded."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, *columns: np.ndarray):
        if len(keys):
            order = np.argsort(keys) if columns else None
            keys = keys[order] if columns else np.sort(keys)
            new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            self.parts.append((keys[new], np.diff(np.append(new, len(keys))), *(x[order[new]] for x in columns)))
            self.held += len(self.parts[-1][0])
        if self.held > FLUSH:
            yield from self.flush(MOST)

    def flush(self, most: int = 0):
        if not self.parts:
            return
        rows = add_up(*(np.concatenate(x) for x in zip(*self.parts)))
        self.parts, self.held = [], 0
        if len(rows[0]) > most:
            yield rows
        else:
            self.parts, self.held = [rows], len(rows[0])


def sequences(hasher: Hasher, data: np.ndarray, bounds: np.ndarray):
    """Keys of all tokens of a chunk in order, each document's end token after its words, and the
    position where each document starts (and the end)."""
    rows = len(bounds) - 1
    _, _, row, h = hasher.tokens(data, bounds, lower=True)
    first = np.zeros(rows + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=rows) + 1, out=first[1:])
    keys = np.full(first[-1], END, np.uint64)
    keys[np.arange(len(h)) + row] = h
    return keys, first


# Rows on their way to the task that adds them up: arrays of many rows of one kind, by the first bits of a hash.
PACKED = "part int, kind int, key binary, n binary, ctx binary, suffix binary, level binary"
WORDS, ONCE, MORE, PAIRS, KNOWN, LATE = range(6)  # kinds


def _part_bits(spark) -> int:
    """Parts, many for each task, so that a hash deals them evenly."""
    return (8 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def _by_bytes(kind: int, column: str) -> bool:
    """Whether a column's cells are byte by byte: not where whole values repeat."""
    return column in ("key", "n") or (kind, column) == (LATE, "ctx")


def _pack(kind: int, bits: int, top: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """One row of PACKED for each value of the first ``bits`` bits of ``top``, by which the rows are sorted."""
    part = top >> np.uint64(64 - bits)
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = np.append(at, len(part))

    def cells(name):
        if name not in columns:
            return pa.nulls(len(at), pa.binary())
        x = np.ascontiguousarray(columns[name])
        if _by_bytes(kind, name):
            rows, x = x.view(np.uint8).reshape(len(x), x.itemsize), np.empty_like(x)
            out = x.view(np.uint8)
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                out[a * x.itemsize:b * x.itemsize] = rows[a:b].T.ravel()
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(x)])

    return pa.RecordBatch.from_arrays(
        [pa.array(part[at].astype(np.int32)), pa.array(np.full(len(at), kind, np.int32)),
         *(cells(x) for x in ("key", "n", "ctx", "suffix", "level"))],
        names=["part", "kind", "key", "n", "ctx", "suffix", "level"])


def _gathered(batches, *names: str):
    """The named columns' arrays, of MOST rows or more at a time, as a few rows would make as many cells."""
    parts, held = [], 0
    for batch in batches:
        parts.append([batch.column(x).to_numpy() for x in names])
        held += batch.num_rows
        if held >= MOST:
            yield [np.concatenate(x) for x in zip(*parts)]
            parts, held = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*parts)]


def _seen(bits: int, keys: np.ndarray, counts: np.ndarray):
    """Which keys a task found once and which more often, by 32 bits after the part's: enough to leave out
    nearly all that are found once in all."""
    for kind, some in ((ONCE, counts == 1), (MORE, counts > 1)):
        if some.any():
            yield _pack(kind, bits, keys[some], key=(keys[some] >> np.uint64(32 - bits)).astype(np.uint32))


def _unpacked(batches) -> dict:
    """kind: (parts, columns by name: list of arrays) of a task's PACKED rows."""
    types = {"key": np.uint64, "n": np.uint32, "ctx": np.uint64, "suffix": np.uint64, "level": np.int16}
    out: dict = {}
    for batch in batches:
        part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
        for i in range(batch.num_rows):
            parts, columns = out.setdefault(int(kind[i]), ([], {x: [] for x in types}))
            parts.append(int(part[i]))
            for x, t in types.items():
                cell = batch.column(x)[i].as_buffer()
                if cell is not None:
                    t = np.dtype(np.uint32 if x == "key" and kind[i] in (ONCE, MORE) else t)
                    if _by_bytes(kind[i], x):
                        cell = np.ascontiguousarray(np.frombuffer(cell, np.uint8).reshape(t.itemsize, -1).T)
                    columns[x].append(np.frombuffer(cell, t))
    return out


def _joined(columns: dict, *names: str) -> list[np.ndarray]:
    return [np.concatenate(columns[x]) for x in names]


def _twice(got: dict, bits: int) -> np.ndarray:
    """First SET_BITS bits of the keys that were found twice or more, of ``_unpacked`` rows."""
    found = []
    for kind, times in ((ONCE, 1), (MORE, 2)):
        if kind in got:
            parts, columns = got[kind]
            key = [(np.uint64(p) << np.uint64(32)) | x.astype(np.uint64) for p, x in zip(parts, columns["key"])]
            found += key * times
    if not found:
        return np.zeros(0, np.uint32)
    found = np.sort(np.concatenate(found))
    found = found[1:][found[1:] == found[:-1]]
    return _first_bits(found << np.uint64(32 - bits))


def _first_bits(keys: np.ndarray) -> np.ndarray:
    return np.unique((keys >> np.uint64(64 - SET_BITS)).astype(np.uint32))


def _bounded(counts: DataFrame, least: float):
    """The keys counted at least ``least`` times, sorted, with their counts, on the driver: at most
    the number of tokens divided by ``least``."""
    got = counts.where(F.col("n") >= least).toArrow()
    keys = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], got["n"].to_numpy()[order]


def _rows(schema: str, **columns) -> pa.RecordBatch:
    """A batch of ``schema``; a column that is not given is null. Unsigned arrays are keys."""
    names = [x.split()[0] for x in schema.split(", ")]
    size = max(len(x) for x in columns.values() if x is not None)
    kinds = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}

    def column(x, kind):
        if x is None:
            return pa.nulls(size, kind)
        return x if isinstance(x, pa.Array) else pa.array(x.view(np.int64) if getattr(x, "dtype", None) == np.uint64 else x, kind)

    return pa.RecordBatch.from_arrays([column(columns.get(x.split()[0]), kinds[x.split()[1]]) for x in schema.split(", ")], names=names)


def vocabulary(train: DataFrame):
    """(table ``(key, n, ctx)`` of all tokens, ctx: the key of a token as a context; model: totals and the head in
    arrays; set of the pairs of neighbours found twice)."""
    bits = _part_bits(train.sparkSession)
    schema = "key long, n long, ctx long, found binary"

    def run(batches):
        hasher, words, pairs = Hasher(), Tally(), Tally()

        def send(keys, counts):
            return _pack(WORDS, bits, keys, key=keys, n=counts.astype(np.uint32))

        for batch in batches:
            for _, _, data, bounds in text_chunks(batch.column(0)):
                keys, first = sequences(hasher, data, bounds)
                for got in words.add(keys):
                    yield send(*got)
                at = np.flatnonzero(_back(first) >= 1)
                for got in pairs.add(hasher.grams(hasher.word_prefix(keys), at - 1, 2)):
                    yield from _seen(bits, *got)
        for got in words.flush():
            yield send(*got)
        for got in pairs.flush():
            yield from _seen(bits, *got)

    def add(batches):
        got = _unpacked(batches)
        if WORDS in got:
            keys, counts = _joined(got[WORDS][1], "key", "n")
            keys, counts = add_up(keys, counts.astype(np.int64))
            yield _rows(schema, key=keys, n=counts, ctx=mix(keys))
        if len(found := _twice(got, bits)):
            yield _rows(schema, found=[found.tobytes()])

    table, stats = materialize(train.mapInArrow(run, PACKED).repartition("part").mapInArrow(add, schema), "vocabulary",
                               {"n": F.sum("n"), "v": F.count("key"), "m": F.sum(F.length("found") / 4)})
    vocab = table.where("found is null").drop("found")
    total, different = int(stats["n"] or 0), int(stats["v"] or 0)
    head_least = max(1.0, HEAD_SHARE * total)
    head, head_n = _bounded(vocab.select("key", "n"), head_least)
    floor = total + ADD * (different + 1)
    return vocab, {"total": total, "different": different, "floor": floor, "head": head, "head_n": head_n,
                   "head_least": head_least}, BitSet.found(table.select("found"), stats["m"])


class BitSet:
    """Top bits of 64-bit hashes: says yes for every member, and for few others."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @classmethod
    def of(cls, hashes: DataFrame, column: str, n: int):
        bits = min(SET_BITS, max(12, int(n).bit_length() + 4))
        at = F.shiftrightunsigned(column, 64 - bits)
        got = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")).toArrow()
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
        return cls(bits, words)

    @classmethod
    def found(cls, cells: DataFrame, n):
        """Of cells of first bits (``_first_bits``), about ``n`` in all; other cells are null."""
        bits = min(SET_BITS, max(12, int(n or 0).bit_length() + 4))

        def run(batches):
            for batch in batches:
                for cell in batch.column(0).drop_null():
                    at = np.frombuffer(cell.as_buffer(), np.uint32) >> np.uint32(SET_BITS - bits)
                    word = at >> np.uint32(6)
                    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                    b = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint32(63)).astype(np.uint64), first)
                    yield pa.RecordBatch.from_arrays([pa.array([word[first].tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())],
                                                     names=["w", "b"])

        words = np.zeros(1 << (bits - 6), np.uint64)
        for r in cells.where(F.col(cells.columns[0]).isNotNull()).mapInArrow(run, "w binary, b binary").toArrow().to_pylist():
            words[np.frombuffer(r["w"], np.uint32)] |= np.frombuffer(r["b"], np.uint64)
        return cls(bits, words)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _plain(levels: list[dict]) -> list[dict]:
    """The bit sets as numbers and arrays: a broadcast names classes, which workers may not be able to import."""
    return [{k: (v.bits, v.words) for k, v in level.items()} for level in levels]


def _made(levels: list[dict]) -> list[dict]:
    return [{k: BitSet(*v) for k, v in level.items()} for level in levels]


def _back(first: np.ndarray) -> np.ndarray:
    """Words before each token, in its document."""
    return np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))


def _walk(hasher: Hasher, keys: np.ndarray, first: np.ndarray, levels: list[dict], more: int = 1):
    """Per level, from 1 on: positions whose context of that many words is gathered, the contexts'
    hashes, and a function for the hashes of the last words before and with the token. ``levels``
    has the bit sets of the levels done; ``more`` levels follow them."""
    prefix = hasher.word_prefix(keys)
    back = _back(first)
    at = np.arange(len(keys))
    for d in range(1, len(levels) + more + 1):
        at = at[back[at] >= d]
        context = hasher.grams(prefix, at - d, d)
        if d == 2:  # a context of two words is a pair of level 1
            some = levels[0]["pair"].has(context)
            at, context = at[some], context[some]

        def upto(words, at=at):
            return hasher.grams(prefix, at - words, words + 1)
        yield at, context, upto
        if d <= len(levels):
            at = at[levels[d - 1]["alive"].has(context)]


def _after(hasher: Hasher, keys: np.ndarray, first: np.ndarray, done: list[dict], more: int):
    """``_walk``, the levels after the done ones only: (level, positions, contexts, hashes). A context that is
    extended has only such suffixes, so the last level done tells most; the others meet what its set says wrongly."""
    prefix, back, last = hasher.word_prefix(keys), _back(first), len(done)
    at = np.flatnonzero(back > last)
    for d in range(last, 0, -1):
        at = at[done[d - 1]["alive"].has(hasher.grams(prefix, at - d, d))]
    for d in range(last + 1, last + more + 1):
        at = at[back[at] >= d]

        def upto(words, at=at):
            return hasher.grams(prefix, at - words, words + 1)
        if len(at):
            yield d, at, hasher.grams(prefix, at - d, d), upto


def _send(train: DataFrame, value):
    shared = train.sparkSession.sparkContext.broadcast(value)
    current_scope().spent.append(shared)
    return shared


def _pairs(train: DataFrame, levels: list[dict], twice: BitSet, model: dict, least: float, scope: Scratch):
    """``(key, ctx, n, suffix, q)``, written, of level 1 or 2 (the one after ``levels``): how often a token follows a
    context, where that is ``least`` times or more. key: context and token; suffix: the same without the first word
    (level 1: the token); q: at level 1 the root's probability of a token in the head, else null. Then the set of
    these keys, and for level 1 that of the next level's keys that are found twice. ``twice`` says which keys can be
    found ``least`` times; no others leave the text."""
    bits, level = _part_bits(train.sparkSession), len(levels) + 1
    root = (model["head_n"] + ADD) / model["floor"]
    shared = _send(train, (_plain([*levels, {"twice": twice}]), (model["head"], root) if level == 1 else None))
    schema = "key long, ctx long, n long, suffix long, q double, found binary, next binary"

    def run(batches):
        *done, often = _made(shared.value[0])
        hasher, tally, after = Hasher(), Tally(), Tally()

        def send(keys, counts, ctx, suffix):
            key = {} if level == 1 else {"key": keys}  # two words give their key
            return _pack(PAIRS, bits, keys, n=counts.astype(np.uint32), ctx=ctx, suffix=suffix, **key)

        for batch in batches:
            for _, _, data, bounds in text_chunks(batch.column(0)):
                keys, first = sequences(hasher, data, bounds)
                if level == 1:
                    prefix, back = hasher.word_prefix(keys), _back(first)
                    at = np.flatnonzero(back >= 1)
                    key = hasher.grams(prefix, at - 1, 2)
                    some = often["twice"].has(key)
                    at, key = at[some], key[some]
                    columns = keys[at - 1], keys[at]
                    both = np.zeros(len(keys) + 1, bool)
                    both[at] = True
                    at = at[both[at - 1] & (back[at] >= 2)]
                    for got in after.add(hasher.grams(prefix, at - 2, 3)):
                        yield from _seen(bits, *got)
                else:
                    key, columns = np.zeros(0, np.uint64), ()
                    for _, at, _, upto in _after(hasher, keys, first, done, 1):
                        at = at[often["twice"].has(upto(level))]
                        suffix = upto(level - 1, at)
                        some = done[-1]["pair"].has(suffix)
                        at = at[some]
                        key, columns = upto(level, at), (upto(level - 1, at - 1), suffix[some])
                for got in tally.add(key, *columns):
                    yield send(*got)
        for got in tally.flush():
            yield send(*got)
        for got in after.flush():
            yield from _seen(bits, *got)

    def add(batches):
        got = _unpacked(batches)
        if PAIRS in got:
            columns = got.pop(PAIRS)[1]
            n, ctx, suffix = _joined(columns, "n", "ctx", "suffix")
            key = _joined(columns, "key")[0] if level > 1 else Hasher().pairs(ctx, suffix)
            key, n, ctx, suffix = add_up(key, n.astype(np.int64), ctx, suffix)
            some = n >= least
            key, n, ctx, suffix = key[some], n[some], ctx[some], suffix[some]
            q = None
            if level == 1:
                words, root = shared.value[1]
                ctx, at = mix(ctx), Lookup(words).find(suffix)
                q = pa.array(root[at] if len(root) else np.zeros(len(at)), mask=at < 0)
            if len(key):
                yield _rows(schema, key=key, ctx=ctx, n=n, suffix=suffix, q=q)
                yield _rows(schema, found=[_first_bits(key).tobytes()])
        if len(found := _twice(got, bits)):
            yield _rows(schema, next=[found.tobytes()])

    table, stats = materialize(
        train.mapInArrow(run, PACKED).repartition("part").mapInArrow(add, schema), f"counts{level}",
        {x: F.sum(F.length(x) / 4) for x in ("found", "next")}, scope=scope)
    return (table.where("key is not null").drop("found", "next"), BitSet.found(table.select("found"), stats["found"]),
            BitSet.found(table.select("next"), stats["next"]) if level == 1 else None)


def _level(counts: DataFrame, pairs: DataFrame, divergence: float, level: int):
    """(contexts that are states or extended: ``ctx, c, left, state, alive``; their gathered tokens:
    ``key, ctx, n, q, p, left, state, alive``; counts). q is the probability in the shorter state, p
    in the longest state up to the context, left the mass that a state leaves to the shorter one.
    ``counts(ctx, c)``: the contexts' own counts. ``pairs``: written ``(key, ctx, n, q)``."""
    n, q, z = F.col("n"), F.col("q"), 0.9 * divergence

    def over(n, r):  # n max(0, log(r / z) - 1)
        return n * F.greatest(F.log(r / z) - 1, F.lit(0.0))

    sums = pairs.groupBy("ctx").agg(
        F.sum("n").alias("kept"), F.sum("q").alias("kept_q"), F.sum(n * F.log(n / q)).alias("g"),
        F.sum(n * F.log(n)).alias("nl"), F.sum(-n * F.log(q)).alias("most"), F.sum(over(n, n / q)).alias("over"))
    sums = sums.join(counts, "ctx")
    c, kept = F.col("c"), F.col("kept")
    rest, rest_q = c - kept, F.greatest(1 - F.col("kept_q"), F.lit(1e-12))
    left = 1 - kept / (c + KAPPA)

    def others(value):  # all other tokens together
        return F.when(rest > 0, value).otherwise(0.0)

    state = F.col("g") + others(rest * F.log(rest / rest_q)) - c * F.log(c) >= divergence
    rest_p = left * rest_q
    # In a state p >= n / (c + KAPPA).
    bound = F.when(state, F.least(
        kept * F.log(c + KAPPA) - F.col("nl") - others(rest * F.log(rest_p)),
        z + over(kept, c + KAPPA) + others(over(rest, rest / rest_p)))).otherwise(F.least(
            F.col("most") - others(rest * F.log(rest_q)), z + F.col("over") + others(over(rest, rest / rest_q))))
    kept = sums.select("ctx", "c", left.alias("left"), state.alias("state"), (bound >= divergence).alias("alive"))
    kept, stats = materialize(kept.where("state or alive"), f"contexts{level}", {
        "states": F.count(F.when(F.col("state"), 1)), "alive": F.count(F.when(F.col("alive"), 1)),
        "tokens": F.sum(F.when(F.col("alive"), F.col("c")))})
    p = F.when(F.col("state"), n / (F.col("c") + KAPPA) + F.col("left") * q).otherwise(q)
    after = materialize(pairs.join(kept, "ctx").select("key", "ctx", "n", "q", p.alias("p"), "left", "state", "alive"),
                        f"followers{level}")
    return kept, after, stats


def _test_levels(t: dict, start: int, last: int, divergence: float):
    """``_level`` for the levels ``start`` to ``last`` of some contexts, in arrays: yields (level,
    contexts: ctx, c, left, state, alive; pairs: key, n, added, p, alive, ctx) of each. ``t`` has the columns of
    the pairs (paired) and of the contexts' own counts, and what is known of the level before (known:
    its keys, sorted; p)."""
    keys, probs, z = t["known"], t["p"], 0.9 * divergence

    def over(n, r):
        return n * np.maximum(np.log(np.maximum(r, 1e-300) / z) - 1, 0)

    for d in range(start, last + 1):
        here = t["level"] == d
        ctx, number = np.unique(t["ctx"][here], return_inverse=True)
        pair = t["paired"][here]
        c = np.bincount(number[~pair], t["n"][here][~pair], len(ctx))
        key, n, number, suffix = t["key"][here][pair], t["n"][here][pair].astype(float), number[pair], t["suffix"][here][pair]
        at = np.minimum(np.searchsorted(keys, suffix), max(len(keys) - 1, 0))
        there = keys[at] == suffix if len(keys) else np.zeros(len(suffix), bool)
        key, n, number, q = key[there], n[there], number[there], probs[at[there]] if len(keys) else np.zeros(0)
        if not len(key):
            return

        def total(x):
            return np.bincount(number, x, len(ctx))

        kept, rest_q = total(n), np.maximum(1 - total(q), 1e-12)
        rest, left = c - kept, 1 - kept / (c + KAPPA)
        some = rest > 0
        r = np.where(some, rest, 1)
        state = total(n * np.log(n / q)) + np.where(some, r * np.log(r / rest_q), 0) - c * np.log(c) >= divergence
        rest_p = left * rest_q
        in_state = np.minimum(kept * np.log(c + KAPPA) - total(n * np.log(n)) - np.where(some, r * np.log(rest_p), 0),
                              z + over(kept, c + KAPPA) + np.where(some, over(r, r / rest_p), 0))
        other = np.minimum(total(-n * np.log(q)) - np.where(some, r * np.log(rest_q), 0),
                           z + total(over(n, n / q)) + np.where(some, over(r, r / rest_q), 0))
        state &= kept > 0
        alive = (np.where(state, in_state, other) >= divergence) & (kept > 0)
        p = np.where(state[number], n / (c[number] + KAPPA) + left[number] * q, q)
        take = state | alive
        mine = take[number]
        yield (d, (ctx[take], c[take], left[take], state[take], alive[take]),
               (key[mine], n[mine], np.where(state[number], np.log10(p / (left[number] * q)), np.nan)[mine], p[mine], alive[number][mine], ctx[number][mine]))
        mine = alive[number]
        order = np.argsort(key[mine])
        keys, probs = key[mine][order], p[mine][order]


def _levels(train: DataFrame, levels: list[dict], before: DataFrame, divergence: float, more: int, least: float):
    """(contexts ``level, key, n, value, state, alive``, gathered tokens likewise with ``ctx, p``) of the ``more``
    levels after ``levels`` in one written table, and counts. ``before``: ``(key, ctx, p)`` of the level before.
    Contexts and the tokens after them are dealt by what the levels done have of the context, counted and tested there.
    Tokens that are not gathered after the context's suffix cannot be gathered after it, and count for the context only."""
    bits, start, last = _part_bits(train.sparkSession), len(levels) + 1, len(levels) + more
    shared = _send(train, _plain(levels))

    def run(batches):
        done, hasher, tally = _made(shared.value), Hasher(), Tally()

        def send(key, n, base, ctx, suffix, level):
            order = np.lexsort((level, base >> np.uint64(64 - bits)))
            return _pack(PAIRS, bits, base[order], key=key[order], n=n[order].astype(np.uint32), ctx=ctx[order], suffix=suffix[order], level=level[order])

        for batch in batches:
            for _, _, data, bounds in text_chunks(batch.column(0)):
                keys, first = sequences(hasher, data, bounds)
                for d, at, context, upto in _after(hasher, keys, first, done, more):
                    base, none = upto(start - 2, at - 1), np.zeros(len(at), np.uint64)
                    for got in tally.add(context ^ _LEFT, base, none, none, np.full(len(at), -d, np.int16)):
                        yield send(*got)
                    some = done[-1]["pair"].has(upto(start - 1, at))
                    at, context, base = at[some], context[some], base[some]
                    for got in tally.add(upto(d, at), base, context, upto(d - 1, at), np.full(len(at), d, np.int16)):
                        yield send(*got)
        for got in tally.flush():
            yield send(*got)

    def pack(batches):
        for key, ctx, p in _gathered(batches, "key", "ctx", "p"):
            key, top = key.view(np.uint64), ctx.view(np.uint64) >> np.uint64(64 - bits)
            order = np.lexsort((key, top))
            yield _pack(KNOWN, bits, ctx.view(np.uint64)[order], key=key[order], ctx=p[order].view(np.uint64))

    def test(batches):
        got = _unpacked(batches)
        if PAIRS not in got or KNOWN not in got:
            return
        key, n, ctx, suffix, level = _joined(got.pop(PAIRS)[1], "key", "n", "ctx", "suffix", "level")
        key, n, ctx, suffix, level = add_up(key, n.astype(np.int64), ctx, suffix, level)
        some = n >= least
        key, n, ctx, suffix, level = key[some], n[some], ctx[some], suffix[some], level[some]
        known, p = _joined(got.pop(KNOWN)[1], "key", "ctx")
        order = np.argsort(known)
        t = {"key": key, "n": n, "suffix": suffix, "level": np.abs(level), "paired": level > 0,
             "ctx": np.where(level > 0, ctx, key ^ _LEFT), "known": known[order], "p": p.view(np.float64)[order]}
        for d, (ctx, c, left, state, alive), (key, n, added, p, on, of) in _test_levels(t, start, last, divergence):
            own, size = len(ctx), len(ctx) + len(key)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(size, d, np.int32)), pa.array(np.arange(size) < own),
                pa.array(np.concatenate([ctx, key]).view(np.int64)), pa.array(np.concatenate([ctx, of]).view(np.int64)),
                pa.array(np.concatenate([c, n]).astype(np.int64)), pa.array(np.concatenate([np.log10(left), added])),
                pa.array(np.concatenate([np.ones(own), p])), pa.array(np.concatenate([state, ~np.isnan(added)])),
                pa.array(np.concatenate([alive, on]))],
                names=["level", "own", "key", "ctx", "n", "value", "p", "state", "alive"])

    rows = train.mapInArrow(run, PACKED).union(before.select("key", "ctx", "p").mapInArrow(pack, PACKED))
    out = rows.repartition("part").mapInArrow(
        test, "level int, own boolean, key long, ctx long, n long, value double, p double, state boolean, alive boolean")
    end = F.col("own") & F.col("alive") & (F.col("level") == last)
    return materialize(out, f"levels{start}", {
        "pairs": F.count(F.when(~F.col("own"), 1)), "states": F.count(F.when(F.col("own") & F.col("state"), 1)),
        "on": F.count(F.when(F.col("own") & F.col("alive"), 1)),
        "alive": F.count(F.when(end, 1)), "tokens": F.sum(F.when(end, F.col("n")))})


def grow(train: DataFrame, vocab: DataFrame, model: dict, twice: BitSet, share: float = 0.0,
         divergence: float = DIVERGENCE, depth: int = DEPTH):
    """(bit sets of each level, factors). factors: written ``(key, n, value)``, log10 of the mass
    that a state leaves (its key: the context's) and of what it adds to that for a gathered token.
    ``twice``: the pairs of neighbours that are found twice."""
    least = max(LEAST, share * model["total"])
    levels, factors, before, scope, more = [], None, None, current_scope(), 1
    alive, seen = Scratch(), Scratch()
    counts = vocab.select("ctx", F.col("n").alias("c"))  # every word is followed by a token
    while len(levels) < depth:
        level = len(levels) + 1
        with scratch_scope(train.sparkSession):
            current_scope().folders += alive.folders + seen.folders  # the level before goes when this one is done
            alive, seen, raw, former = Scratch(), Scratch(), Scratch(), alive
            if level > 2:
                tested, stats = _levels(train, levels, before, divergence, more, least)
                own, pair = F.col("own"), ~F.col("own")
                sets = {"pair": BitSet.of(tested.where(pair), "key", stats["pairs"]),
                        "alive": BitSet.of(tested.where(own & F.col("alive")), "key", stats["on"]),
                        "state": BitSet.of(tested.where(own & F.col("state")), "key", stats["states"])}
                key = F.when(own, F.col("key").bitwiseXOR(F.lit(int(_LEFT)))).otherwise(F.col("key"))
                factors = factors.union(materialize(
                    tested.where("state").select(key.alias("key"), "n", "value"), f"factors{level}", scope=scope))
                levels += [sets] * more
                if not stats["alive"] or len(levels) >= depth:
                    break
                before = materialize(tested.where(pair & F.col("alive") & (F.col("level") == len(levels))).select("key", "ctx", "p"),
                                     f"alive{level}", scope=alive)
                more = min(depth - len(levels), max(1, model["total"] // (BATCH * stats["tokens"])))
                continue
            pairs, found, after = _pairs(train, levels, twice, model, least, raw)
            if level == 1:  # a token in the head needs no join
                some = vocab.select(F.col("key").alias("suffix"), ((F.col("n") + ADD) / model["floor"]).alias("q"))
                tested = pairs.where("q is not null").select("key", "ctx", "n", "q").union(
                    pairs.where("q is null").drop("q").join(some, "suffix").select("key", "ctx", "n", "q"))
            else:
                some = before.select(F.col("key").alias("suffix"), F.col("p").alias("q"))
                tested = pairs.drop("q").join(some, "suffix").select("key", "ctx", "n", "q")
            tested = materialize(tested, f"pairs{level}")
            raw.release(train.sparkSession)
            former.release(train.sparkSession)
            kept, gathered, stats = _level(counts, tested, divergence, level)
            levels.append({"pair": found, "alive": BitSet.of(kept.where("alive"), "ctx", stats["alive"]),
                           "state": BitSet.of(kept.where("state"), "ctx", stats["states"])})
            added = gathered.where("state").select("key", "n", F.log10(F.col("p") / (F.col("left") * F.col("q"))).alias("value"))
            own = kept.where("state").select(F.col("ctx").bitwiseXOR(F.lit(int(_LEFT))), "c", F.log10("left"))
            own = materialize(added.union(own), f"factors{level}", scope=scope)
            before = materialize(gathered.where("alive").select("key", *["ctx"] * (level > 1), "p"), f"alive{level}", scope=alive)
            if level == 1 and stats["alive"]:  # a pair is a context of two words
                counts, twice = materialize(tested.select(F.col("key").alias("ctx"), F.col("n").alias("c")), "contexts", scope=seen), after
        factors = own if factors is None else factors.union(own)
        if not stats["alive"]:
            break
        more = min(depth - len(levels), max(1, model["total"] // (BATCH * stats["tokens"])))
    scope.folders += alive.folders + seen.folders
    return levels, factors


def _most_frequent(factors: DataFrame, most: int):
    """(class, keys, values): the factors of the highest classes of counts, at most ``most`` of
    them, and the lowest of these classes (null: no class fits)."""
    kind = F.floor(F.log2("n") * 4)
    lowest, total = None, 0
    for r in factors.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("kind")).collect():
        total += r["m"]
        if total > most:
            break
        lowest = r["kind"]
    if lowest is None:
        return None, np.zeros(0, np.uint64), np.zeros(0)
    got = factors.where(kind >= lowest).select("key", "value").toArrow()
    return lowest, got["key"].to_numpy().view(np.uint64), got["value"].to_numpy()


def held_out(doc_id: str) -> Column:
    """One document in ten, by its id alone."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def _late(factors: DataFrame, vocab: DataFrame, model: dict, lowest) -> DataFrame:
    """PACKED rows (ctx: the value's bits) of what is not looked up where the text is: words outside the head (a part
    that was counted as that of an unseen one) and the other factors."""
    bits = _part_bits(vocab.sparkSession)

    def packed(kind):
        def run(batches):
            for key, value in _gathered(batches, "key", "value"):
                key = key.view(np.uint64)
                order = np.argsort(key)
                yield _pack(kind, bits, key[order], key=key[order], ctx=value[order].view(np.uint64))
        return run

    more = F.log10((F.col("n") + F.lit(ADD)) / F.lit(ADD))
    seen = vocab.where(F.col("n") < model["head_least"]).select("key", more.alias("value"))
    seldom = factors if lowest is None else factors.where(F.floor(F.log2("n") * 4) < lowest)
    return seen.mapInArrow(packed(WORDS), PACKED).union(seldom.select("key", "value").mapInArrow(packed(KNOWN), PACKED))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.0,
                    divergence: float = DIVERGENCE, depth: int = DEPTH) -> DataFrame:
    """One row per document: ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)``. base_score and score are log10 probabilities of the whole text under the root and
    under the suffix tree. A state is seen LEAST times, and ``share`` of the training tokens."""
    with shuffles_dropped(docs.sparkSession):
        return _score_documents(docs, doc_id, text, share, divergence, depth)


def _score_documents(docs: DataFrame, doc_id: str, text: str, share: float, divergence: float, depth: int) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(doc_id).alias("held_out"))
    train = rows.where("not held_out").select("text")
    vocab, model, twice = vocabulary(train)
    spark = docs.sparkSession
    levels, factors = grow(train, vocab, model, twice, share, divergence, depth)
    lowest, *often = _most_frequent(factors, HEAD_FACTORS)
    shared = spark.sparkContext.broadcast({"model": (model["head"], np.log10((model["head_n"] + ADD) / model["floor"])),
                                           "often": often, "levels": _plain(levels)})
    unseen = float(np.log10(ADD / model["floor"])) if model["total"] else 0.0

    bits, kind = _part_bits(spark), dict(rows.dtypes)["doc_id"]
    own = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "tree"]
    own_schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, tree double"
    packed_names = [x.split()[0] for x in PACKED.split(", ")]

    def run(batches):
        held = shared.value
        if "lookups" not in held:
            held["lookups"] = Lookup(held["model"][0]), Lookup(held["often"][0])
            held["sets"] = _made(held["levels"])
            one = mix(held["model"][0])  # the head's words as contexts: states, and the places of their factors
            held["one"] = np.where(held["sets"][0]["state"].has(one), held["lookups"][1].find(one ^ _LEFT), -2)
        (in_vocab, in_often), word_part = held["lookups"], held["model"][1]
        hasher, number = Hasher(), TaskContext.get().partitionId() << 40
        late, waiting, types = [], 0, None

        def send():
            key, row, times = (np.concatenate(x) for x in zip(*late))
            order = np.argsort(key)
            cells = _pack(LATE, bits, key[order], key=key[order], ctx=row[order], n=times[order])
            late.clear()
            return pa.RecordBatch.from_arrays([*cells.columns, *(pa.nulls(cells.num_rows, x) for x in types)],
                                              names=[*packed_names, *own])

        for batch in batches:
            for a, b, data, bounds in text_chunks(batch.column("text")):
                keys, first = sequences(hasher, data, bounds)
                n = np.diff(first)
                of = np.repeat(np.arange(b - a), n)
                found = in_vocab.find(keys)
                known = found >= 0
                base = np.full(len(keys), unseen)
                base[known] = word_part[found[known]]
                tree = np.bincount(of, base, b - a)
                late_row, late_key = [of[~known]], [keys[~known]]

                def factor(row, key):
                    hit = in_often.find(key)
                    yes = hit >= 0
                    late_row.append(row[~yes])
                    late_key.append(key[~yes])
                    return np.bincount(row[yes], held["often"][1][hit[yes]], b - a)

                for d, (at, context, upto) in enumerate(_walk(hasher, keys, first, held["sets"][:-1]), 1):
                    level = held["sets"][d - 1]
                    if d == 1:
                        place = np.where(known[at - 1], held["one"][found[at - 1]] if len(held["one"]) else 0, -1)
                        direct = at[place >= 0]
                        tree += np.bincount(of[direct], held["often"][1][place[place >= 0]], b - a)
                        at, context = at[place == -1], context[place == -1]
                        some = level["state"].has(context)
                        at, context = at[some], context[some]
                        tree += factor(of[at], context ^ _LEFT)
                        at = np.concatenate([direct, at])
                    else:
                        some = level["state"].has(context)
                        at, context = at[some], context[some]
                        tree += factor(of[at], context ^ _LEFT)
                    key = upto(d, at)
                    some = level["pair"].has(key)
                    tree += factor(of[at[some]], key[some])
                row, key = np.concatenate(late_row), np.concatenate(late_key)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
                at = np.flatnonzero(new)
                late.append((key[at], (row[at] + number).astype(np.uint64), np.diff(np.append(at, len(row))).astype(np.uint32)))
                waiting += len(at)
                numbers = np.arange(number, number + b - a)
                documents = [
                    pa.array(numbers), batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                    pa.array(n), pa.array(np.add.reduceat(known, first[:-1], dtype=np.int64)),
                    pa.array(np.bincount(of, base, b - a)), pa.array(tree)]
                types = [x.type for x in documents]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((numbers % (1 << bits)).astype(np.int32)), pa.nulls(b - a, pa.int32()),
                     *(pa.nulls(b - a, pa.binary()) for _ in packed_names[2:]), *documents], names=[*packed_names, *own])
                number += b - a
                if waiting > MOST:
                    yield send()
                    waiting = 0
        if waiting:
            yield send()

    def find(batches):
        held, types = {}, None
        for batch in batches:
            document = batch.column("kind").is_null()
            types = [batch.column(x).type for x in own]
            yield batch.filter(document).select(own)
            for which, (_, columns) in _unpacked([batch.filter(pc.invert(document))]).items():
                for x in ("key", "ctx", "n"):
                    held.setdefault(which, {}).setdefault(x, []).extend(columns[x])
        if LATE not in held:
            return
        key, row, times = _joined(held.pop(LATE), "key", "ctx", "n")
        row, of = np.unique(row, return_inverse=True)
        known, words, tree, any_hit = np.zeros(len(row)), np.zeros(len(row)), np.zeros(len(row)), np.zeros(len(row), bool)
        for which in (WORDS, KNOWN):
            if which in held:
                keys, values = _joined(held.pop(which), "key", "ctx")
                at = Lookup(keys).find(key)
                hit = at >= 0
                part = np.bincount(of[hit], times[hit] * values.view(np.float64)[at[hit]], len(row))
                any_hit[of[hit]] = True
                tree += part
                if which == WORDS:
                    words = part
                    known = np.bincount(of[hit], times[hit], len(row))
        numbers = [row.astype(np.int64), known.astype(np.int64), words, tree]
        row, known, words, tree = (x[any_hit] for x in numbers)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row), *(pa.nulls(len(row), x) for x in types[1:4]), pa.array(known), pa.array(words), pa.array(tree)], names=own)

    whole, rounds = None, max(1, min(ROUNDS, model["total"] // ROUND_TOKENS))
    for at in range(rounds):
        some = rows if rounds == 1 else rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == at)
        cells = some.mapInArrow(run, f"{PACKED}, {own_schema}").unionByName(
            _late(factors, vocab, model, lowest), allowMissingColumns=True)
        parts = cells.repartition("part").mapInArrow(find, own_schema)
        scored = materialize(parts.groupBy("row").agg(
            *[F.first(x, ignorenulls=True).alias(x) for x in own[1:4]], *[F.sum(x).alias(x) for x in own[4:]]), "scored")
        whole = scored if whole is None else whole.union(scored)
    shared.destroy()
    return whole.select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"),
        F.lit(model["total"]).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
        F.col("tree").alias("score"))
