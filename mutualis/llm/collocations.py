"""Phrase collocations, counted by multikey three-way quicksort of suffix pointers.

Texts (A-Z lower-cased) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, pieces into words
``[^\\x20\\x09]+``. A suffix is a word's place with at most ``LONGEST`` words of its piece from there
on; equal suffixes of a task are one record with a count. Everything is counted per language (null:
``und``): a word's key is a 64-bit hash of the word and its language.

Leading pairs are counted first (added up in each task, then by Spark). A suffix is cut before the first
pair with fewer than ``least`` occurrences, since no phrase across it can have more. The frequent pairs are
told by a bit set of at most 2^SET_BITS bits: it may say yes wrongly, more often where there are more
pairs than bits, and then longer suffixes are routed, to the same counts.

Suffixes are routed by their leading words: by the first alone where that is no hot word, else by as
many as it takes to reach one that is not (hot: at least ``hot_share`` of all words, so there are
at most 1/hot_share of them, which are broadcast). So one task's share of a route is below
``hot_share`` of all words, or one record for each task before. In its task a route is a partition of
suffix pointers, to be sorted on from the first word that its routing left open: a pivot word splits a
partition into lower, equal and higher pointers; the equal part has one word more in common, and
its size is that phrase's count. A part with fewer than ``least`` occurrences is abandoned, as no phrase in
it can have more. All partitions of a run are split at once, so a round is a few array operations.
Phrases shorter than what a route was dealt by are in several routes: their parts are added up
after that (the only ones that are not abandoned before their count is whole).

Null text is empty. A text is handled as one chunk of its task whatever its length, nothing longer is
held. Repeated rows count each time. Ties are told in ``collocations``. An empty table gives no row.
Only the two named columns are read, whatever the others are called.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import current_scope, materialize, scratch_scope
from .textcore import Hasher, byte_set, mix, text_chunks

LONGEST = 4
LEAST = 30
LIMIT = 2000
ABSORB = 80          # a longer phrase with so many hundredths of the count takes a shorter one's place
HOT_SHARE = 1e-4
HELD = 1 << 20       # suffixes held in a task before equal ones are added up and sent
SET_BITS = 27
RUN = 1 << 19        # suffixes sorted at once (more where one route has more)
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CHUNK = 1 << 20
WORDS = [f"w{i + 1}" for i in range(LONGEST)]


def _lang_keys(langs: pa.Array) -> np.ndarray:
    """A 64-bit value for every row's language."""
    codes = langs.dictionary_encode()
    own = [int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in codes.dictionary.to_pylist()]
    return np.array(own, np.uint64)[codes.indices.to_numpy()] if len(langs) else np.zeros(0, np.uint64)


def _keyed_words(batches):
    """Per chunk of texts: (languages, bytes, starts, ends, row, key, piece) of its words."""
    hasher, breaks = Hasher(byte_set(b" \t" + _BREAKS)), byte_set(_BREAKS)
    for batch in batches:
        langs = batch.column(0)
        own = _lang_keys(langs)
        for a, b, data, bounds in text_chunks(batch.column(1), _CHUNK):
            starts, ends, row, h = hasher.tokens(data, bounds, lower=True)
            if len(h):
                key = mix(h ^ own[a:b][row])
                key[key == 0] = 1  # 0 stands for no word
                yield langs.slice(a, b - a), data, starts, ends, row, key, np.cumsum(breaks[data])[starts]


def vocabulary(rows: DataFrame) -> DataFrame:
    """``(lang, word, key, n)`` of all words of ``rows(lang, text)``."""
    def run(batches):
        for langs, data, starts, ends, row, key, _ in _keyed_words(batches):
            key, first, n = np.unique(key, return_index=True, return_counts=True)
            size = (ends - starts)[first]
            offsets = np.zeros(len(first) + 1, np.int64)
            np.cumsum(size, out=offsets[1:])
            at = np.repeat(starts[first] - offsets[:-1], size) + np.arange(offsets[-1])
            upper = (data[at] >= 0x41) & (data[at] <= 0x5A)
            text = pa.LargeStringArray.from_buffers(
                len(first), pa.py_buffer(offsets), pa.py_buffer(np.where(upper, data[at] + 32, data[at]).astype(np.uint8)))
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(row[first])), text.cast(pa.string()), pa.array(key.view(np.int64)), pa.array(n)],
                names=["lang", "word", "key", "n"])

    out = rows.mapInArrow(run, "lang string, word string, key long, n long")
    return out.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _alike(words: list[np.ndarray]):
    """Marks where a row of sorted ``words`` differs from the one before."""
    new = np.ones(len(words[0]), bool)
    new[1:] = False
    for w in words:
        new[1:] |= w[1:] != w[:-1]
    return new


def _fold(words: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(words[0]), np.uint64)
    for w in words:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) ^ w)
    return out


def _add_up(words: list[np.ndarray], n: np.ndarray):
    """Equal rows of ``words`` as one, their counts added."""
    if not len(n):
        return words, n
    order = np.argsort(_fold(words))
    words = [w[order] for w in words]
    at = np.flatnonzero(_alike(words))
    return [w[at] for w in words], np.add.reduceat(n[order], at)


def _follows(row: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Places of words with a next word in their piece."""
    return np.flatnonzero((row[1:] == row[:-1]) & (piece[1:] == piece[:-1]))


def _leading_pairs(rows: DataFrame) -> DataFrame:
    """``(pair, n)`` of all neighbouring words of a piece, by a 64-bit key."""
    def run(batches):
        held, size = [], 0

        def send():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["pair", "n"])

        for _, _, _, _, row, key, piece in _keyed_words(batches):
            at = _follows(row, piece)
            held.append(_fold([key[at], key[at + 1]]))
            size += len(at)
            if size > HELD:
                yield send()
                held, size = [], 0
        if size:
            yield send()

    return rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _bit_set(hashes: DataFrame, column: str, n: int) -> np.ndarray:
    """Bits of the hashes' leading bits, 16 to 32 bits for each of ``n`` hashes, 2^SET_BITS at most."""
    bits = min(SET_BITS, max(12, int(n).bit_length() + 4))
    at = F.shiftrightunsigned(column, 64 - bits)
    got = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return out


def _in_bits(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - (len(bits).bit_length() + 5))
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _suffixes(rows: DataFrame, hot: np.ndarray, often: np.ndarray) -> DataFrame:
    """``(route, open, w1.., n)``: suffixes of two words or more; the first ``open`` words made the route.
    often: bit set of the frequent pairs."""
    shared = rows.sparkSession.sparkContext.broadcast((hot, often))

    def run(batches):
        (hot, often), held, size = shared.value, [], 0

        def send():
            words, n = _add_up([np.concatenate(x) for x in zip(*held)], np.ones(size, np.int64))
            depth, lead = np.ones(len(n), np.int8), np.ones(len(n), bool)
            for w in words[:-1]:
                lead &= np.isin(w, hot)
                depth += lead
            shown = [np.where(depth > i, w, np.uint64(0)) for i, w in enumerate(words)]
            route = _fold([*shown, depth.astype(np.uint64)])
            return pa.RecordBatch.from_arrays(
                [pa.array(route.view(np.int64)), pa.array(depth), *[pa.array(w.view(np.int64)) for w in words],
                 pa.array(n.astype(np.int32))], names=["route", "open", *WORDS, "n"])

        for _, _, _, _, row, key, piece in _keyed_words(batches):
            at = _follows(row, piece)
            at = at[_in_bits(often, _fold([key[at], key[at + 1]]))]
            on = np.zeros(len(key) + LONGEST, bool)  # is the pair that begins here frequent
            on[at] = True
            there, words = np.ones(len(at), bool), [key[at]]
            for i in range(1, LONGEST):
                there = there & on[at + i - 1]
                words.append(np.where(there, key[np.minimum(at + i, len(key) - 1)], np.uint64(0)))
            held.append(words)
            size += len(at)
            if size > HELD:
                yield send()
                held, size = [], 0
        if size:
            yield send()

    return rows.mapInArrow(run, f"route long, open tinyint, {', '.join(f'{w} long' for w in WORDS)}, n int")


def sorted_counts(words: list[np.ndarray], n: np.ndarray, starts: np.ndarray, depth: np.ndarray, least: int):
    """Multikey three-way quicksort of suffixes that lie in partitions (``starts``), each with its
    first ``depth`` words in common: yields ``(row, length, count)`` arrays of the phrases with at least
    ``least`` occurrences, as a suffix that begins with the phrase and the phrase's length."""
    order, depth = np.arange(len(n)), depth.astype(np.int64)
    first = True
    while len(order):
        sizes = np.diff(np.append(starts, len(order)))
        count = np.add.reduceat(n[order], starts)
        if first:  # what the routes have in common is a phrase already
            equal, first = np.ones(len(starts), bool), False
        lead = order[starts]
        ended = np.zeros(len(starts), bool)  # no word at the last place in common
        for i in range(LONGEST):
            here = depth == i + 1
            ended[here] = words[i][lead[here]] == 0
        found = equal & ~ended & (count >= least) & (depth > 1)
        yield lead[found], depth[found], count[found]
        on = (count >= least) & ~ended & (depth < LONGEST)
        order = order[np.repeat(on, sizes)]
        sizes, depth = sizes[on], depth[on]
        starts = np.cumsum(sizes) - sizes
        if not len(order):
            return
        part, level = np.repeat(np.arange(len(sizes)), sizes), np.repeat(depth, sizes)
        value = np.choose(level - 1, [w[order] for w in words[1:]])
        pivot = value[starts + sizes // 2][part]
        side = (value >= pivot).astype(np.int64) + (value > pivot)
        deal = part * 3 + side
        move = np.argsort(deal, kind="stable")
        order, deal = order[move], deal[move]
        starts = np.flatnonzero(_alike([deal]))
        equal = deal[starts] % 3 == 1
        depth = depth[deal[starts] // 3] + equal


def _routed_counts(suffixes: DataFrame, least: int) -> DataFrame:
    """``(w1.., n)``: counts of phrases, of those shorter than their routes in parts."""
    def count(parts):
        route, depth, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1, -1))
        words = [np.concatenate([p[i + 2] for p in parts]) for i in range(LONGEST)]
        starts = np.flatnonzero(_alike([route]))
        total, level = np.add.reduceat(n, starts), depth[starts]
        out = []
        for rows, length, c in sorted_counts(words, n, starts, level, least):
            out.append(([np.where(length > i, w[rows], np.uint64(0)) for i, w in enumerate(words)], c))
        for size in range(2, LONGEST):
            some = (level > size) & (words[size - 1][starts] != 0)
            short = [w[starts[some]] if i < size else np.zeros(some.sum(), np.uint64) for i, w in enumerate(words)]
            out.append(_add_up(short, total[some]))
        return pa.RecordBatch.from_arrays(
            [*[pa.array(np.concatenate([x[0][i] for x in out]).view(np.int64)) for i in range(LONGEST)],
             pa.array(np.concatenate([x[1] for x in out]))], names=[*WORDS, "n"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append([cols[0], cols[1], *[c.view(np.uint64) for c in cols[2:2 + LONGEST]], cols[-1].astype(np.int64)])
            size += batch.num_rows
            if size > RUN and cols[0][-1] != held[0][0][0]:
                last = int(np.flatnonzero(cols[0] != cols[0][-1])[-1]) + 1 if (cols[0] != cols[0][-1]).any() else 0
                keep = len(held) - 1
                while not last and held[keep - 1][0][-1] == cols[0][-1]:  # the last route reaches further back
                    keep -= 1
                    other = np.flatnonzero(held[keep][0] != cols[0][-1])
                    last = int(other[-1]) + 1 if len(other) else 0
                rest = [[c[last:] for c in held[keep]], *held[keep + 1:]]
                yield count([*held[:keep], [c[:last] for c in held[keep]]])
                held, size = rest, sum(len(r[0]) for r in rest)
        if held:
            yield count(held)

    dealt = suffixes.repartition("route").sortWithinPartitions("route")
    return dealt.mapInArrow(run, f"{', '.join(f'{w} long' for w in WORDS)}, n long")


def phrase_counts(rows: DataFrame, least: int = LEAST, hot_share: float = HOT_SHARE):
    """(vocabulary ``lang, word, key, n``; phrases of 2 to 4 words ``w1.., n`` with ``least``
    occurrences or more) of ``rows(lang, text)``: written tables."""
    scope = current_scope()
    with scratch_scope(rows.sparkSession):
        words, seen = materialize(vocabulary(rows), "vocabulary", {"total": F.sum("n")}, scope=scope)
        hot = words.where(F.col("n") >= max(1.0, hot_share * (seen["total"] or 0))).select("key").toArrow()
        hot = np.sort(hot["key"].to_numpy().view(np.uint64))
        pairs, seen = materialize(_leading_pairs(rows).where(F.col("n") >= least).select("pair"), "pairs",
                                  {"n": F.count(F.lit(1))})
        parts = _routed_counts(_suffixes(rows, hot, _bit_set(pairs, "pair", seen["n"])), least)
        counts = parts.groupBy(*WORDS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        return words, materialize(counts, "phrases", scope=scope)


def _cuts():
    """Each (length, cut, side) with the words of that side, of a phrase of that length."""
    for length in range(2, LONGEST + 1):
        for k in range(1, length):
            yield length, k, 0, range(k)
            yield length, k, 1, range(k, length)


def _picked(places) -> list[Column]:
    return [*[F.col(WORDS[i]).alias(f"p{j + 1}") for j, i in enumerate(places)],
            *[F.lit(0).cast("long").alias(f"p{j + 1}") for j in range(len(places), LONGEST)]]


def _by_length(phrases_of) -> Column:
    """The array that ``phrases_of(length)`` gives for a phrase of that length."""
    length = sum((F.when(F.col(w) != 0, 1).otherwise(0) for w in WORDS), F.lit(0))
    out = F.when(F.lit(False), phrases_of(LONGEST))
    for n in range(2, LONGEST + 1):
        out = out.when(length == n, phrases_of(n))
    return out


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, limit: int = LIMIT,
                 absorb: int = ABSORB, hot_share: float = HOT_SHARE) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``limit`` phrases of 2 to 4
    words by score, then count, both descending, then phrase in byte order, so no two tie.

    a: occurrences of the phrase within pieces, overlaps included, ``least`` at least; l, r: those of
    its two sides at the cut of the lowest score floor(2000000 a / (l + r)), the first of equal ones; n:
    all words of the language. A phrase goes if a longer one holding its words in a row has ``absorb``
    hundredths of its count or more. Numbers are exact (decimals where a product may pass 64 bits).
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words, phrases = phrase_counts(rows, least, hot_share)
    cuts = list(_cuts())
    parts = _by_length(lambda n: F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("s"), *_picked(at))
                                           for length, k, s, at in cuts if length == n]))
    sides = phrases.select(*WORDS, F.col("n").alias("a"), F.explode(parts).alias("x")).select(*WORDS, "a", "x.*")
    ps = [f"p{i + 1}" for i in range(LONGEST)]
    none = F.lit(0).cast("long")
    known = words.where(F.col("n") >= least).select(
        F.col("key").alias("p1"), *[none.alias(p) for p in ps[1:]], F.col("n").alias("f"), F.col("lang")).unionByName(
        phrases.select(*[F.col(w).alias(p) for w, p in zip(WORDS, ps)], F.col("n").alias("f"),
                       F.lit(None).cast("string").alias("lang")))
    met = sides.join(known, ps).groupBy(*WORDS, "a").agg(
        F.max(F.when((F.col("k") == 1) & (F.col("s") == 0), F.col("lang"))).alias("lang"),
        *[F.max(F.when((F.col("k") == k) & (F.col("s") == s), F.col("f"))).alias(f"{side}{k}")
          for k in range(1, LONGEST) for s, side in enumerate("lr")])

    def cut(k):
        score = F.expr(f"cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div cast(l{k} + r{k} as decimal(20,0))")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(
            score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    scored = met.select(*WORDS, "lang", "a", F.least(*[cut(k) for k in range(1, LONGEST)]).alias("c")).select(
        *WORDS, "lang", "a", "c.score", "c.l", "c.r")
    inside = _by_length(lambda n: F.array(*[F.struct(*_picked(range(i, i + m)))
                                            for m in range(2, n) for i in range(n - m + 1)]) if n > 2
                        else F.array().cast("array<struct<p1:bigint,p2:bigint,p3:bigint,p4:bigint>>"))
    longer = phrases.select("n", F.explode(inside).alias("x")).select(
        "n", *[F.col(f"x.{p}").alias(w) for p, w in zip(ps, WORDS)]).groupBy(*WORDS).agg(F.max("n").alias("longer"))
    wide = "cast({} as decimal(7,0)) * cast({} as decimal(20,0))"
    left = scored.join(longer, WORDS, "left").where(
        F.col("longer").isNull() | F.expr(f"{wide.format(100, 'longer')} < {wide.format(int(absorb), 'a')}"))
    order = [F.desc("score"), F.desc("a")]
    by_lang = Window.partitionBy("lang")
    first = materialize(left.withColumn("rank", F.rank().over(by_lang.orderBy(*order))).where(F.col("rank") <= limit),
                        "ranked")  # with all that tie for the last place
    texts = first.select(*WORDS, F.posexplode(F.array(*WORDS)).alias("i", "key")).where("key <> 0").join(
        words.select("key", "word"), "key").groupBy(*WORDS).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    named = first.drop("rank").join(texts, WORDS).join(total, "lang")
    rank = F.row_number().over(by_lang.orderBy(*order, F.asc("phrase")))
    return named.withColumn("rank", rank.cast("long")).where(F.col("rank") <= limit).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
