"""Words and word-window hashes of whole Arrow batches, as numpy arrays.

A word is a run of bytes outside space and ``\\t\\n\\v\\f\\r``; on UTF-8 bytes that is the pattern
``[^\\x20\\x09-\\x0D]+`` on the text. Hashes are 64-bit: a polynomial over the words (mod 2^64, odd
base, so any window is a difference of two prefix sums) put through an avalanche mix.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def text_name(column: str) -> Column:
    """128 bits that stand for a text, and whether there is one: ``struct<a:bigint,b:bigint>``."""
    c = F.col(column)
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c.isNull(), F.reverse(c)).alias("b"))


TEXT_NAME = "struct<a:bigint,b:bigint>"  # type of a text's name
CHUNK_BYTES = 1 << 18  # text handled at once; a longer document is a chunk of its own
CHUNK_ROWS = 1024
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (two multiply-shift rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
        return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Powers:
    """Powers of an odd base and of its inverse, grown on demand and kept for the task."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1024)
            self.up, self.down = powers(self.base, size), powers(self.inverse, size)
        return self.up[:n], self.down[:n]


def text_chunks(column, limit: int = CHUNK_BYTES):
    """Yield ``(first row, end row, bytes, bounds)`` over a string column; null is empty text.

    ``bytes`` is a uint8 view of the rows' UTF-8, ``bounds`` has each row's start and the end.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for top in range(0, len(column), CHUNK_ROWS):
        part = column.slice(top, CHUNK_ROWS).cast(pa.large_string()).fill_null("")
        n, bufs = len(part), part.buffers()
        offsets = np.frombuffer(bufs[1], np.int64)[part.offset:part.offset + n + 1]
        data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
        a = 0
        while a < n:
            b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
            b = min(max(b, a + 1), n)
            yield top + a, top + b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            a = b


_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def byte_set(chars: bytes) -> np.ndarray:
    """Flags of the 256 byte values, set for those in ``chars``."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


class Hasher:
    """Word spans and hashes; one per task (holds the power tables). ``gaps``: flags of the bytes
    between words (white space, where nothing else is given)."""

    def __init__(self, gaps: np.ndarray | None = None):
        self.bytes, self.words = Powers(_BYTE_BASE), Powers(_WORD_BASE)
        self.gaps = _WS if gaps is None else gaps

    def spans(self, data: np.ndarray, bounds: np.ndarray):
        """Start and end byte of every word and the row it is in; words end at row ends."""
        n = len(data)
        inside = np.zeros(n + 1, bool)
        np.logical_not(self.gaps[data], out=inside[:n])
        before = np.zeros(n + 1, bool)  # is the byte before in the same word's reach
        before[1:] = inside[:n]
        before[bounds] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(n + 1, bool)  # does the word end just before this byte
        after[1:] = inside[:n]
        same = inside.copy()
        same[bounds] = False
        ends = np.flatnonzero(after & ~same)
        row = np.searchsorted(bounds, starts, side="right") - 1
        return starts, ends, row

    def prefix(self, data: np.ndarray) -> np.ndarray:
        up, _ = self.bytes.get(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
        return out

    def slices(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte slice."""
        _, down = self.bytes.get(len(prefix))
        with np.errstate(over="ignore"):
            return mix((prefix[ends] - prefix[starts]) * down[starts])

    def tokens(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False):
        """(starts, ends, row, hash) of every word."""
        starts, ends, row = self.spans(data, bounds)
        prefix = self.prefix(_LOWER[data] if lower else data)
        return starts, ends, row, self.slices(prefix, starts, ends)

    def word_prefix(self, h: np.ndarray) -> np.ndarray:
        up, _ = self.words.get(len(h) + 1)
        out = np.zeros(len(h) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(h * up[:-1], out=out[1:])
        return out

    def grams(self, prefix: np.ndarray, at: np.ndarray, n) -> np.ndarray:
        """Hash of the ``n`` words from word ``at`` (n a number or an array)."""
        _, down = self.words.get(len(prefix))
        with np.errstate(over="ignore"):
            return mix((prefix[at + n] - prefix[at]) * down[at])

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Hash of each two words, given by their hashes: as ``grams`` gives it."""
        up, _ = self.words.get(2)
        with np.errstate(over="ignore"):
            return mix(first + second * up[1])


def row_sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each [bounds[i], bounds[i+1])."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


class Lookup:
    """Position of 64-bit values in an array of different ones: mixed, found by their top bits,
    then compared one by one (a few at most, whatever the values)."""

    def __init__(self, keys: np.ndarray):
        mixed = mix(keys.astype(np.uint64))
        self.place = np.argsort(mixed)
        self.keys = mixed[self.place]
        self.bits = np.uint64(64 - max(10, min(22, int(len(keys)).bit_length() + 2)))
        slots = 1 << (64 - int(self.bits))
        self.first = np.searchsorted(self.keys >> self.bits, np.arange(slots + 1, dtype=np.uint64))
        self.deepest = int(np.diff(self.first).max()) if len(keys) else 0

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, -1 where it is absent."""
        out = np.full(len(values), -1, np.int64)
        if not len(self.keys) or not len(values):
            return out
        h = mix(values)
        slot = (h >> self.bits).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        todo = np.flatnonzero(at < end)
        for step in range(self.deepest):
            if not len(todo):
                break
            here = at[todo] + step
            hit = self.keys[here] == h[todo]
            out[todo[hit]] = self.place[here[hit]]
            todo = todo[~hit & (here + 1 < end[todo])]
        return out


def give_back():
    """Return memory that earlier tasks of this worker freed to the system, where the system has a way."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
