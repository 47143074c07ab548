"""SimHash near-duplicates: fingerprints, a pivot distance table, linked groups.

Fingerprint: 64 bits over the XXH64 values (seed 42, unsigned) of a text's word shingles, repeats
included; a bit is 1 if it is set in over half of them.

Pairs within ``max_bits`` differing bits are found over the *different* fingerprints only. The
reference fingerprints (pivots) are zero and one for each two-bit block (its two bits set); the
table holds each fingerprint's Hamming distances to all of them. By the triangle inequality a pair
within d bits differs by at most d in every coordinate. Candidates come from an equality the
coordinates imply: of ``groups`` groups of blocks at most d can hold a differing bit, so the
coordinates of the other groups are equal (relative to the distance to zero, which counts the bits
outside too). Pairs whose largest coordinate difference exceeds d are discarded, survivors are
verified on the fingerprints themselves. No link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import current_scope, materialize, scratch_scope
from .components import components
from .textcore import text_name

SHINGLE = 3
MAX_BITS = 2
BLOCKS = 32           # two-bit blocks of the 64 bits
BUCKET_ROWS = 512     # a bucket with more members is split by further coordinates
_LANES = 0x0101010101010101


def shingle_hashes(text: str | None, n: int) -> list[int]:
    """XXH64 (seed 42) of every n-word shingle of the lower-cased (A-Z) text."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode().lower().split()
    if not words:
        return []
    if len(words) <= n:
        return [xxh64_intdigest(b" ".join(words), 42)]
    join = b" ".join
    return [xxh64_intdigest(join(s), 42) for s in zip(*[words[i:] for i in range(n)])]


def bits_over_half(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``sizes[i]`` hashes.

    The 64 counters are kept in the byte lanes of 8 words and summed over runs of at most 255
    hashes, so no lane overflows; then the runs of a text are added.
    """
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(sizes)), runs)
    if not len(owner):
        return np.zeros(len(sizes), np.uint64)
    ends = np.cumsum(sizes)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = (ends - sizes)[owner] + 255 * index
    count = np.zeros((len(sizes), 64), np.int64)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & np.uint64(_LANES), at)
        wide = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        np.add.at(count, (owner[:, None], 8 * np.arange(8)[None, :] + shift), wide)
    bits = (2 * count > sizes[:, None]).astype(np.uint64)
    return np.bitwise_or.reduce(bits << np.arange(64, dtype=np.uint64), axis=1)


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
                 keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``fp`` (the 64 bits as a signed long). Null text has no words."""
    carried = docs.columns if keep is None else keep
    carried = [c for c in carried if c != "fp"]
    kept = docs.select(*[f"`{c}`" for c in carried])
    schema = T.StructType([*kept.schema.fields, T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            texts, out = batch.column(batch.num_columns - 1), []
            for a in range(0, len(texts), 256):
                lists = [shingle_hashes(t.as_py(), shingle) for t in texts.slice(a, 256)]
                sizes = np.array([len(x) for x in lists], np.int64)
                flat = np.array([v for x in lists for v in x], np.uint64)
                out.append(bits_over_half(flat, sizes).view(np.int64))
            fp = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(fp)],
                names=[*carried, "fp"])

    return docs.select(*[f"`{c}`" for c in carried], docs[text].alias("_fp_text")).mapInArrow(run, schema)


def pivots() -> np.ndarray:
    """The reference fingerprints: zero, then each two-bit block's."""
    return np.array([0, *[3 << (2 * b) for b in range(BLOCKS)]], np.uint64)


def pivot_distances(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every pivot (one int8 row each)."""
    return np.bitwise_count(fp[:, None] ^ pivots()[None, :]).astype(np.int8)


def _key(d: np.ndarray, blocks: list[int]) -> np.ndarray:
    """The coordinates of some blocks, relative to the distance to zero, as one number (base 3)."""
    at = np.array(blocks) + 1
    digits = (d[:, at].astype(np.int64) - d[:, :1]) // 2 + 1
    return digits @ (3 ** np.arange(len(blocks), dtype=np.int64))


def _choices(blocks: list[int], max_bits: int) -> list[list[int]]:
    """Choices of blocks one of which holds no differing bit: the blocks in max_bits + 2 parts,
    all but ``max_bits`` parts."""
    n = max_bits + 2
    parts = [blocks[i * len(blocks) // n:(i + 1) * len(blocks) // n] for i in range(n)]
    return [[b for p in c for b in p] for c in combinations(parts, n - max_bits)]


def pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``, a < b: links that join the different fingerprints within ``max_bits`` bits.

    ``fps`` has one row per different fingerprint in ``fp``. A bucket (equal coordinates of a
    choice of blocks) over BUCKET_ROWS members is split by the same pigeonhole among its remaining
    blocks, so a large cluster is not compared all against all.
    """
    choices = _choices(list(range(BLOCKS)), max_bits)
    finer = [_choices([b for b in range(BLOCKS) if b not in c], max_bits) for c in choices]

    def table(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            d = pivot_distances(fp.view(np.uint64))
            raw = pa.array([x.tobytes() for x in d], pa.binary())
            for i, blocks in enumerate(choices):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp), raw, pa.array(np.full(len(fp), i, np.int32)), pa.array(_key(d, blocks))],
                    names=["fp", "d", "c", "k"])

    def split(batches):
        for batch in batches:
            fp, raw, c, k, n = (batch.column(i) for i in range(5))
            at, which = np.arange(len(fp)), c.to_numpy(zero_copy_only=False)
            d = np.frombuffer(b"".join(raw.to_pylist()), np.int8).reshape(len(fp), BLOCKS + 1)
            large = n.to_numpy(zero_copy_only=False) > BUCKET_ROWS
            out = [(at[~large], 0, np.zeros((~large).sum(), np.int64))]
            for i, subs in enumerate(finer):
                mine = at[large & (which == i)]
                out += [(mine, j + 1, _key(d[mine], blocks)) for j, blocks in enumerate(subs) if len(mine)]
            for rows, c2, k2 in out:
                yield pa.RecordBatch.from_arrays(
                    [fp.take(pa.array(rows)), raw.take(pa.array(rows)), c.take(pa.array(rows)),
                     k.take(pa.array(rows)), pa.array(np.full(len(rows), c2, np.int32)), pa.array(k2)],
                    names=["fp", "d", "c", "k", "c2", "k2"])

    keyed = materialize(fps.select("fp").mapInArrow(table, "fp long, d binary, c int, k long"), "pivot_table")
    sizes = materialize(keyed.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    near = keyed.join(sizes, ["c", "k"]).select("fp", "d", "c", "k", "n").mapInArrow(
        split, "fp long, d binary, c int, k long, c2 int, k2 long")

    def link(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy()
        d = np.frombuffer(b"".join(table.column("d").to_pylist()), np.int8).reshape(len(fp), BLOCKS + 1)
        linked = _spanning(fp.view(np.uint64), d, max_bits)
        return pa.table({"a": fp[linked[:, 0]], "b": fp[linked[:, 1]]})

    found = near.groupBy("c", "k", "c2", "k2").applyInArrow(link, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _spanning(fp: np.ndarray, d: np.ndarray, max_bits: int) -> np.ndarray:
    """Links that join every linked group of a bucket: one per member, not one per pair.

    Grows each group breadth first: a member's distances to those not reached yet are compared by
    the largest coordinate difference, survivors by their bits.
    """
    left, links = np.arange(len(fp)), []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            some = left[(np.abs(d[left] - d[x]) <= max_bits).all(axis=1)]
            some = some[np.bitwise_count(fp[some] ^ fp[x]) <= max_bits]
            if len(some):
                links += [(x, y) for y in some]
                todo += list(some)
                left = left[~np.isin(left, some)]
    return np.array(links, np.int64).reshape(-1, 2)


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int):
    """(documents: ``doc_id, fp``; fingerprints: ``fp, component``; groups: ``component, first``).
    first is a group's smallest (no id, doc_id, name of the text); all three are written tables."""
    named = docs.select(F.col(doc_id).alias("doc_id"), text_name(text).alias("t"), F.col(text).alias("text"))
    rows = materialize(fingerprints(named, "text", shingle, ["doc_id", "t"]), "fingerprints")
    low = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")).alias("first")
    held = current_scope()
    with scratch_scope(docs.sparkSession):
        nodes = materialize(rows.groupBy("fp").agg(low), "fp_nodes")
        comp = components(pairs(nodes.select("fp"), max_bits))
        named = nodes.join(comp, nodes.fp == comp.node, "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("component"))
        named = materialize(named, "fp_components", scope=held)
    groups = materialize(named.groupBy("component").agg(F.min("first").alias("first")), "fp_groups")
    return rows, named.select("fp", "component"), groups


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``(doc_id, fp, component_id)``; component_id is the smallest id that
    can be reached over links of at most ``max_bits`` bits.

    Equal fingerprints are one node, whatever the number of copies. Texts without words have the
    zero fingerprint, linked like any other. A null id stays null and is no candidate for
    component_id unless its whole group has none. Repeated rows give repeated rows.
    """
    rows, named, groups = _grouped(docs, doc_id, text, shingle, max_bits)
    ids = named.join(groups, "component").select("fp", F.col("first.doc_id").alias("component_id"))
    return rows.join(materialize(ids, "fp_names"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each linked group: the one with the smallest id (of several
    texts with that id, the one of the smallest name; of repeated rows, one). A document without an id
    stands only if its group has none with an id."""
    _, _, groups = _grouped(docs, doc_id, text, shingle, max_bits)
    # The same plain key without nulls for both steps, so that the texts are shuffled once at most.
    key = [F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("some_id"), F.col("t")]
    kept = groups.select(F.col("first.doc_id").alias("id"), F.col("first.t").alias("t")).select(*key)
    packed = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"),
                         F.col(doc_id).alias("id"), text_name(text).alias("t")).select("row", *key)
    names = ["no_id", "some_id", "t"]
    return packed.join(kept, names, "left_semi").dropDuplicates(names).select("row.*")
