"""Quality rules: repetition inside a document, from its suffix array.

Per document that repeats any ``min_words`` words: its suffixes (by word) are sorted by prefix
doubling; the longest common prefix (LCP) with each neighbour gives, for every suffix, the deepest
LCP interval it lies in, that is the longest repeated substring that starts there. The spans of
those substrings are united; a document is rejected when the united spans cover more than
``max_covered`` of its words or a repeated substring has more than ``max_longest`` words. Intervals
that could be lengthened to the left lie inside the span of the suffix before.

Null text: no words. Texts under 50 words fail the base rule. Rows repeated or without an id are
judged like any other; a row's verdict depends on its own text only, so the operator is one pass
over the table without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textcore import Hasher, mix, row_sums, text_chunks

MIN_WORDS = 8       # shortest repeated substring that counts
MAX_COVERED = 0.4   # largest share of words inside repeated substrings
MAX_LONGEST = 100   # largest repeated substring, words
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "sa_covered_words", "sa_longest"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _salted(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys that are equal only inside one row."""
    with np.errstate(over="ignore"):
        return mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice."""
    order = np.argsort(keys)
    s = keys[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(s), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def _united(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def suffix_order(h: np.ndarray, row: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The suffixes that start at words ``at`` (whole documents), sorted word by word within each
    document, by prefix doubling: suffixes equal in their first ``width`` words are ordered by the
    rank of what follows; only those still tied are sorted again."""
    n = len(at)
    rank = np.full(len(h) + 1, -1, np.int64)
    order = np.lexsort((h[at], row[at]))
    new = np.ones(n, bool)
    x, y = at[order[1:]], at[order[:-1]]
    new[1:] = (h[x] != h[y]) | (row[x] != row[y])
    # A suffix's rank is the place where its tied class starts.
    rank[at[order]] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied, width = at, 1
    while True:
        size = np.bincount(rank[tied], minlength=n)
        tied = tied[size[rank[tied]] > 1]
        if not len(tied):
            break
        after = tied + width
        follow = np.where(after < end[tied], rank[np.minimum(after, len(h))], -1)
        key = rank[tied] * (n + 1) + follow + 1
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        old = rank[tied]
        place = np.arange(len(tied))
        in_class = place - np.searchsorted(old, old)
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.maximum.accumulate(np.where(new, place, 0))
        rank[tied] = old + in_class[start]
        width *= 2
    out = np.empty(n, np.int64)
    out[rank[at]] = at
    return out


def repeated_substrings(hasher: Hasher, h: np.ndarray, row: np.ndarray, end: np.ndarray,
                        min_words: int, among: np.ndarray | None = None):
    """(word, length): for each suffix in an LCP interval of ``min_words`` or more, the longest.

    ``end[i]`` is the end of word i's document; matches stay inside one document. ``among``: words
    at which alone a repeat can start, if that is known.
    """
    n = len(h)
    at = np.arange(n) if among is None else among
    at = at[at + min_words <= end[at]]
    if not len(at):
        return at, at
    prefix = hasher.word_prefix(h)
    at = at[_repeated(_salted(hasher.grams(prefix, at, min_words), row[at]))]
    if not len(at):
        return at, at
    # Only documents with a repeat are sorted.
    some = np.zeros(int(row[-1]) + 1, bool)
    some[row[at]] = True
    sa = suffix_order(h, row, end, np.flatnonzero(some[row]))
    starts = np.zeros(n, bool)
    starts[at] = True
    sa = sa[starts[sa]]
    a, b = sa[:-1], sa[1:]
    lcp = np.zeros(len(a), np.int64)
    room = np.minimum(end[a] - a, end[b] - b)
    room[row[a] != row[b]] = 0
    step = 1 << max(int(room.max(initial=1)).bit_length() - 1, 0)
    while step:
        fits = np.flatnonzero(lcp + step <= room)
        x, y = a[fits] + lcp[fits], b[fits] + lcp[fits]
        lcp[fits] += step * (hasher.grams(prefix, x, step) == hasher.grams(prefix, y, step))
        step >>= 1
    longest = np.zeros(len(sa), np.int64)
    longest[:-1] = lcp
    longest[1:] = np.maximum(longest[1:], lcp)
    return sa, longest


def measure(hasher: Hasher, data: np.ndarray, bounds: np.ndarray, min_words: int) -> dict:
    """The measures of every row of a chunk."""
    rows = len(bounds) - 1
    starts, _, row, h = hasher.tokens(data, bounds)
    n = len(h)
    n_words = np.bincount(row, minlength=rows).astype(np.int64)
    first = np.zeros(rows + 1, np.int64)
    np.cumsum(n_words, out=first[1:])
    end = first[1:][row] if n else np.zeros(0, np.int64)
    points = row_sums((data & 0xC0) != 0x80, bounds)
    spaces = row_sums(_SPACE[data], bounds)
    out = {"n_words": n_words, "word_chars": points - spaces,
           "n_symbols": row_sums(_SYMBOL[data], bounds)}

    # Lines with a word, less the different ones among them.
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    cut[1:] |= data == 10
    cut[-1] = True
    line_at = np.flatnonzero(cut)
    line_end = np.append(line_at[1:], len(data))
    line_at, line_end = line_at[line_at < len(data)], line_end[line_at < len(data)]
    text_end = line_end - ((line_end > line_at) & (data[line_end - 1] == 10)) if len(line_at) else line_end
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_at)
    line_at, text_end = line_at[has_word], text_end[has_word]
    line_row = np.searchsorted(bounds, line_at, side="right") - 1
    keys = _salted(hasher.slices(hasher.prefix(data), line_at, text_end), line_row)
    order = np.argsort(keys, kind="stable")
    dup = np.zeros(len(keys), bool)
    dup[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    out["n_dup_lines"] = np.bincount(line_row[dup], minlength=rows).astype(np.int64)

    # Words in three-word windows that occur twice.
    at = np.arange(max(n - 2, 0))
    at = at[at + 3 <= end[at]] if n else at
    again = at[:0]
    if len(at):
        prefix = hasher.word_prefix(h)
        again = at[_repeated(_salted(hasher.grams(prefix, at, 3), row[at]))]
    covered = _united(again, np.full(len(again), 3), n)
    out["n_repeat_words"] = np.bincount(row[covered], minlength=rows).astype(np.int64)

    # A repeat of min_words starts with a repeated three-word window (if it has three words).
    sa, longest = repeated_substrings(hasher, h, row, end, min_words,
                                      again if min_words >= 3 else None)
    covered = _united(sa, longest, n)
    out["sa_covered_words"] = np.bincount(row[covered], minlength=rows).astype(np.int64)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, row[sa], longest)
    out["sa_longest"] = top
    return out


def assess(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS,
           max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
           keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept`` added (columns of those names in
    the input are replaced). ``keep``: the input columns to carry, all by default."""
    names = [*MEASURES, "base_failed", "kept"]
    carried = [c for c in (docs.columns if keep is None else keep) if c not in names]
    inner = docs.select(*[f"`{c}`" for c in carried], docs[text].alias("_judged_text"))
    schema = T.StructType([*docs.select(*[f"`{c}`" for c in carried]).schema.fields,
                           *[T.StructField(c, T.LongType()) for c in MEASURES],
                           T.StructField("base_failed", T.BooleanType()),
                           T.StructField("kept", T.BooleanType())])

    def judge(batches):
        hasher = Hasher()
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            parts = [measure(hasher, data, bounds, min_words)
                     for _, _, data, bounds in text_chunks(column)]
            if not parts:
                continue
            m = {c: np.concatenate([p[c] for p in parts]) for c in MEASURES}
            base = ((m["n_words"] < BASE_MIN_WORDS)
                    | (100 * m["n_repeat_words"] > BASE_MAX_REPEAT_PERCENT * m["n_words"]))
            good = (~base & (m["sa_covered_words"] <= max_covered * m["n_words"])
                    & (m["sa_longest"] <= max_longest))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns - 1)],
                 *[pa.array(m[c]) for c in MEASURES], pa.array(base), pa.array(good)],
                names=[*carried, *names])

    return inner.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all its columns and no other."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    judged = assess(plain, f"c{docs.columns.index(text)}", **limits)
    return judged.where("kept").select(*plain.columns).toDF(*docs.columns)
