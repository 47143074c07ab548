"""Brute-force versions of the operators, for small inputs."""

import math
import zlib
from collections import Counter

from xxhash import xxh64_intdigest

LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor ".split()


def words(text):
    return (text or "").encode().split()


def awkward_texts():
    """Nulls, empty, white space, one word, long, repeated, near-equal and non-ASCII texts."""
    base = " ".join(f"w{i}" for i in range(120))
    return [None, "", " \t\n ", "word", "word", base, base, base.replace("w60", "x60"), base.upper(),
            "a b c " * 400, " ".join(f"l{i % 97}x{i}" for i in range(5000)), "é ß Ω 漢字 ﬁ z\x1cq", "x" * 30000,
            "\n".join(["same line here"] * 60), base + " tail " + base, "# * $ % & | < >", None]


def measures(text, min_words=8):
    w = words(text)
    n = len(w)
    rep = set()
    grams = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    for i in range(n - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            rep.update(range(i, i + 3))
    longest, covered = 0, set()
    starts = {}
    for i in range(n - min_words + 1):
        starts.setdefault(tuple(w[i:i + min_words]), []).append(i)
    for places in starts.values():
        for i in places:
            best = 0
            for j in places:
                if i != j:
                    k = 0
                    while max(i, j) + k < n and w[i + k] == w[j + k]:
                        k += 1
                    best = max(best, k)
            longest = max(longest, best)
            covered.update(range(i, i + best))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {"n_words": n, "word_chars": sum(len(x.decode()) for x in w),
            "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(rep),
            "sa_covered_words": len(covered), "sa_longest": longest}


def kept(text, max_covered=0.4, max_longest=100):
    m = measures(text)
    if m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]:
        return False
    return m["sa_covered_words"] <= max_covered * m["n_words"] and m["sa_longest"] <= max_longest


def fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [b" ".join(w)]
    hs = [xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps, max_bits=2):
    """Smallest index reachable from each index."""
    low = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= max_bits and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


def repeats(docs, size):
    """{id: (words at later places, words at first places)} over [(id, text)] in id order."""
    first, count = {}, Counter()
    for i, t in docs:
        w = words(t)
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            first.setdefault(k, (i, p))
            count[k] += 1
    out = {}
    for i, t in docs:
        w, later, here = words(t), set(), set()
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            if count[k] > 1:
                (here if first[k] == (i, p) else later).update(range(p, p + size))
        out[i] = (later, here)
    return out


def scores(docs):
    tokens, c = [], Counter()
    for i, t in docs:
        own = (t or "").encode().lower().split() + [None]
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
        tokens.append((i, held, own))
        if not held:
            c.update(own)
    n, v = sum(c.values()), len(c)
    return [(i, held, len(own), sum(c[x] > 0 for x in own), n,
             sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in own)) for i, held, own in tokens]
