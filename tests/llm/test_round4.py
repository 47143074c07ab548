"""op10: what lies on disk at once, and in what form keys travel."""

import os

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast

from mutualis.llm import pst

WORDS = "the a of data on disk in rounds by hash with keys and counts that compress".split()


def _texts(n=120):
    rnd = np.random.default_rng(2)
    return [(i if i % 9 else None, " ".join(WORDS[x] for x in rnd.zipf(1.4, 80) % len(WORDS))) for i in range(n)]


def _rows(df):
    return sorted(((r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 8),
                    round(r["score"], 8)) for r in df.collect()))


def test_documents_in_rounds(spark, monkeypatch):
    """All documents' late lookups lay on disk at once. Null and repeated ids."""
    docs = spark.createDataFrame(_texts() + _texts(5), "doc_id bigint, text string")
    monkeypatch.setattr(pst, "HEAD_FACTORS", 0)  # every factor is joined
    once = _rows(pst.score_documents(docs, divergence=1.0))
    names, real = [], pst.materialize
    monkeypatch.setattr(pst, "materialize", lambda df, name, *args, **kw: names.append(name) or real(df, name, *args, **kw))
    monkeypatch.setattr(pst, "ROUND_TOKENS", 1)
    assert _rows(pst.score_documents(docs, divergence=1.0)) == once and len(once) == 125
    assert names.count("scored") == pst.ROUNDS
    assert any(abs(r[-1] - r[-2]) > 1 for r in once)


def test_broadcasts_and_raw_counts_go_when_read(spark, monkeypatch):
    """Bit sets that were sent stayed on the driver's disk to the end; counts stayed while their level was tested."""
    made, left, real, level = [], [], Broadcast.__init__, pst._level
    monkeypatch.setattr(Broadcast, "__init__", lambda self, *a, **kw: real(self, *a, **kw) or made.append(self._path))
    folders, path = [], pst.materialize

    def noted(df, name, *args, scope=None, **kw):
        out = path(df, name, *args, scope=scope, **kw)
        if name.startswith("counts"):
            folders.append((scope or pst.current_scope()).folders[-1].removeprefix("file:"))
        return out
    monkeypatch.setattr(pst, "materialize", noted)
    monkeypatch.setattr(pst, "_level", lambda *args: left.append([x for x in folders if os.path.isdir(x)]) or level(*args))
    pst.score_documents(spark.createDataFrame(_texts(), "doc_id bigint, text string"), divergence=1.0).count()
    assert len(folders) == 2 and left == [[], []]
    assert len(made) >= 4 and not any(os.path.exists(x) for x in made if x)


def test_cells_byte_by_byte():
    """Sorted keys and small counts were sent whole: 8 and 4 bytes that hardly compress."""
    rnd = np.random.default_rng(1)
    key = np.sort(rnd.integers(0, 1 << 64, 5000, dtype=np.uint64))
    n = np.minimum(rnd.zipf(2.5, 5000), 1 << 20).astype(np.uint32)
    row = rnd.integers(0, 900, 5000).astype(np.uint64) + np.uint64(3 << 40)
    bits, raw = 5, [x.tobytes() for x in (key, n, row)]
    late = pst._pack(pst.LATE, bits, key, key=key, n=n, ctx=row)
    assert late.num_rows == 32
    got = pst._unpacked([late, pst._pack(pst.PAIRS, bits, key, key=key, n=n, ctx=row, suffix=row, level=np.full(5000, -3, np.int16)),
                         pst._pack(pst.ONCE, bits, key, key=(key >> np.uint64(32 - bits)).astype(np.uint32))])
    for kind, names in ((pst.LATE, ("key", "n", "ctx")), (pst.PAIRS, ("key", "n", "ctx", "suffix", "level")), (pst.ONCE, ("key",))):
        columns = dict(zip(names, pst._joined(got[kind][1], *names)))
        if kind == pst.ONCE:
            assert (columns["key"] == (key >> np.uint64(32 - bits)).astype(np.uint32)).all()
            continue
        assert (columns["key"] == key).all() and (columns["n"] == n).all() and (columns["ctx"] == row).all()
        assert kind == pst.LATE or (columns["level"] == -3).all() and (columns["suffix"] == row).all()

    def packed(cells):
        return len(pa.compress(b"".join(cells), codec="lz4_raw", asbytes=True))
    assert packed([x.as_py() for name in ("key", "n", "ctx") for x in late.column(name)]) < 0.8 * packed(raw)
