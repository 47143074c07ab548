"""MinHash near-duplicates by fast similarity sketching: linked groups of documents.

A document's set is that of its different shingles of five words (A-Z lower-cased; with fewer words the
whole sequence is one; without words it is empty and linked with nothing). Documents with ``100 x
intersection >= percent x union`` are linked. Shingles are known by a 64-bit hash.

Sketch: ``SLOTS`` coordinates. Round i throws every element into a hashed bin with a hashed value; a bin that no
earlier round filled takes the smallest value thrown into it. From round ``SLOTS`` on all elements go into bin
i - SLOTS, so after 2 x SLOTS rounds every coordinate is filled, however small the set; large sets are done
after one or two. Two sets agree in each coordinate with the probability of their similarity, and the
number of agreements is concentrated as with independent coordinates.

Banding: five coordinates make a band. Sets at 0.85 share none of the 25 bands with a probability of
4e-7. Candidates that agree in fewer than ``AGREE`` coordinates go (at 0.85 with a probability
of 1e-10); all others are verified on the full sets.

Equal sets are one node, whatever the number of copies. Within a bucket not all pairs are made: first every
member is paired with the bucket's first, a *star*, and these pairs are verified. Only members that are in
different groups after that are compared each with each, in blocks of ``BLOCK`` on either side (one side: the
members outside the first group); where sizes and sketches allow a link, the sets are intersected there.
So a bucket is never one task's, and pairs that are handed on are fewer than the members, yet no pair that
could link two groups is left out.

Null text is empty. Documents without an id are linked like others; they give no name to a group unless it
has no other. Repeated rows are copies. A text is handled as one chunk of its task whatever its length. An empty
table gives no row. Only the two named columns are read, whatever the others are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, current_scope, materialize, scratch_scope
from .components import components
from .textcore import Hasher, mix, text_chunks

SHINGLE = 5
PERCENT = 85
SLOTS = 125
BAND = 5
AGREE = 75      # agreeing coordinates of a candidate
BLOCK = 256     # members on either side that are compared at once
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.arange(1, 2 * SLOTS + 3, dtype=np.uint64) * _STEP  # one for each round, two for names of sets


def shingle_sets(hasher: Hasher, data: np.ndarray, bounds: np.ndarray, size: int):
    """Sorted different shingle hashes of every row of a chunk, one after the other, and each row's number."""
    rows = len(bounds) - 1
    _, _, row, h = hasher.tokens(data, bounds, lower=True)
    words = np.bincount(row, minlength=rows)
    prefix, first = hasher.word_prefix(h), np.cumsum(words) - words
    at = np.arange(len(h))
    whole = first[row] + words[row] - at >= size
    short = (words > 0) & (words < size)
    start, length = np.concatenate([at[whole], first[short]]), np.concatenate([np.full(whole.sum(), size), words[short]])
    key, row = hasher.grams(prefix, start, length), np.concatenate([row[whole], np.flatnonzero(short)])
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], np.bincount(row[new], minlength=rows)


def sketch(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of ``SLOTS`` values for each set (zeros for an empty one)."""
    out = np.zeros((len(sizes), SLOTS), np.uint64)
    filled = np.zeros((len(sizes), SLOTS), bool)
    left = np.flatnonzero(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    for i in range(2 * SLOTS):
        if not len(left):
            break
        h = mix(keys + _SEEDS[i])
        bins = (h % np.uint64(SLOTS)).astype(np.int64) if i < SLOTS else np.full(len(h), i - SLOTS)
        at = row * SLOTS + bins
        free = ~filled.ravel()[at]
        at, h = at[free], h[free]
        best = np.full(len(sizes) * SLOTS, ~np.uint64(0)) if i == 0 else None
        if best is not None:
            np.minimum.at(best, at, h)
            hit = np.zeros(len(best), bool)
            hit[at] = True
            out.ravel()[hit] = best[hit]
            filled.ravel()[hit] = True
        elif len(at):
            order = np.lexsort((h, at))
            at, h = at[order], h[order]
            new = np.ones(len(at), bool)
            new[1:] = at[1:] != at[:-1]
            out.ravel()[at[new]] = h[new]
            filled.ravel()[at[new]] = True
        done = filled[left].all(axis=1)
        if done.any():
            open_rows = np.zeros(len(sizes), bool)
            left = left[~done]
            open_rows[left] = True
            some = open_rows[row]
            keys, row = keys[some], row[some]
    return out


def _band_keys(s: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    key = np.broadcast_to(np.arange(SLOTS // BAND, dtype=np.uint64) * _STEP, (len(s), SLOTS // BAND)).copy()
    for i in range(BAND):
        key = mix(key * _STEP ^ s[:, i::BAND])
    return key


def sketches(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``(doc_id, row, n, d1, d2, keys, bands, marks)``: row is a number of its own for every row; n the
    set's size, d1 and d2 name the set (128 bits), keys are its shingles, bands the band keys and marks the
    low bytes of the sketch."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        hasher, number = Hasher(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b, data, bounds in text_chunks(batch.column(1)):
                keys, sizes = shingle_sets(hasher, data, bounds, size)
                s = sketch(keys, sizes)
                ends = np.cumsum(sizes)
                names = []
                for k in (1, 2):
                    total = np.zeros(len(keys) + 1, np.uint64)
                    np.cumsum(mix(keys ^ _SEEDS[-k]), out=total[1:])
                    names.append(pa.array(mix(total[ends] - total[ends - sizes]).view(np.int64)))
                some = sizes > 0
                low = np.ascontiguousarray(s.astype(np.uint8))
                bands = _band_keys(s)
                every = np.arange(b - a + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(np.arange(number, number + b - a)),
                    pa.array(sizes.astype(np.int64)), *names,
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(keys.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(every * bands.shape[1]), pa.array(bands.ravel().view(np.int64))),
                    pa.array([bytes(x) if y else None for x, y in zip(low, some)], pa.binary())],
                    names=["doc_id", "row", "n", "d1", "d2", "keys", "bands", "marks"])
                number += b - a

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row long, n long, d1 long, d2 long, keys array<long>, "
                                "bands array<long>, marks binary")


def _marks(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SLOTS)


def _sizes_allow(percent: int) -> str:
    return f"100 * least(n1, n2) >= {int(percent)} * greatest(n1, n2)"


def _alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sizes and sketches allow a link."""
    def run(batches):
        for batch in batches:
            same = (_marks(batch.column("m1")) == _marks(batch.column("m2"))).sum(axis=1) >= AGREE
            yield batch.select(["a", "b"]).filter(pa.array(same))

    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("marks").alias("m1"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("marks").alias("m2"))
    met = pairs.join(one, "a").join(two, "b").where(_sizes_allow(percent))
    return met.select("a", "b", "m1", "m2").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are linked: their full sets are intersected. ``pairs``: written; only
    sets that are in some pair are handed on."""
    some = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = materialize(rows.select("row", "keys").join(materialize(some, "asked"), "row", "left_semi"), "sets")
    one = sets.select(F.col("row").alias("a"), F.col("keys").alias("x"))
    two = sets.select(F.col("row").alias("b"), F.col("keys").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    met = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("all"))
    return met.where(100 * F.col("both") >= percent * (F.col("all") - F.col("both"))).select("a", "b")


def _labels(links: DataFrame, scope: Scratch) -> DataFrame:
    """Written ``(node, label)`` of the linked nodes."""
    with scratch_scope(links.sparkSession):
        return materialize(components(links).select("node", F.col("component").alias("label")), "labels", scope=scope)


def _near(label, n, marks, x, rest, percent: int) -> np.ndarray:
    """Members of ``rest`` with another label than x whose size and sketch allow a link with x."""
    some = rest[label[rest] != label[x]]
    some = some[100 * np.minimum(n[some], n[x]) >= percent * np.maximum(n[some], n[x])]
    return some[(marks[some] == marks[x]).sum(axis=1) >= AGREE]


def _across(members: DataFrame, nodes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join members of a bucket with different labels.

    ``members(key, node, label, other)``: other tells the members outside the first one's group. Others are dealt
    to blocks, all members likewise; a task compares one block of others with one of all members. First by
    sizes and sketches, which gives the members (not the pairs) that have a candidate; then with the sets of
    these, and of the pairs that are verified those that join two groups are emitted: fewer than the members."""
    count = members.groupBy("key").agg(F.ceil(F.sum(F.col("other").cast("int")) / BLOCK).cast("int").alias("bo"),
                                       F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("ba"))
    near = members.join(count, "key").join(nodes.select("node", "n", "marks"), "node")
    cell = F.xxhash64("node")
    left = near.where("other").select("*", F.pmod(cell, F.col("bo")).cast("int").alias("i"), F.lit(True).alias("first")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("ba") - 1)).alias("j"))
    right = near.select("*", F.pmod(cell, F.col("ba")).cast("int").alias("j"), F.lit(False).alias("first")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("bo") - 1)).alias("i"))
    names = ["key", "i", "j", "first", "node", "label", "n", "marks"]
    cells = left.select(*names).union(right.select(*names))

    def sides(table: pa.Table):
        first = table.column("first").to_numpy(zero_copy_only=False)
        label, n = (table.column(c).to_numpy() for c in ("label", "n"))
        return np.flatnonzero(first), np.flatnonzero(~first), label, n, _marks(table.column("marks"))

    def involved(table: pa.Table) -> pa.Table:
        one, rest, label, n, marks = sides(table)
        yes = np.zeros(len(label), bool)
        for x in one:
            some = _near(label, n, marks, x, rest, percent)
            yes[some] = True
            yes[x] = len(some) > 0
        return table.filter(pa.array(yes))

    def verify(table: pa.Table) -> pa.Table:
        one, rest, label, n, marks = sides(table)
        label, node, keys = label.copy(), table.column("node").to_numpy(), table.column("keys").combine_chunks()
        sets = [keys[i].values.to_numpy() for i in range(len(keys))]
        out = []
        for x in one:
            for y in _near(label, n, marks, x, rest, percent):
                if label[x] == label[y]:  # joined meanwhile
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= percent * (n[x] + n[y] - both):
                    out.append((min(node[x], node[y]), max(node[x], node[y])))
                    label[label == label[y]] = label[x]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    some = cells.groupBy("key", "i", "j").applyInArrow(
        involved, "key long, i int, j int, first boolean, node long, label long, n long, marks binary")
    some = materialize(some, "involved")
    asked = materialize(some.select(F.col("node").alias("row")).distinct(), "asked")
    sets = rows.select("row", "keys").join(asked, "row", "left_semi").withColumnRenamed("row", "node")
    return some.join(materialize(sets, "sets"), "node").groupBy("key", "i", "j").applyInArrow(
        verify, "a long, b long").distinct()


def linked(rows: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(nodes ``node, d1, d2, n, ..``: one for each different set; ``(node, label)`` of the linked ones: the
    smallest node that can be reached), written tables. ``rows``: written ``sketches``."""
    scope, spark = current_scope(), rows.sparkSession
    with scratch_scope(spark):
        firsts = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("node"))
        nodes = materialize(firsts, "firsts", scope=scope)
        data = materialize(rows.select(F.col("row").alias("node"), "n", "marks", "bands").join(
            nodes.select("node"), "node", "left_semi"), "nodes")
        members = materialize(data.select("node", F.explode("bands").alias("key")), "members")
        buckets = members.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1")
        buckets = materialize(buckets.select("key", "a"), "buckets")
        members = materialize(members.join(buckets, "key").select("key", "node", "a"), "shared")
        pairs = members.where("node <> a").select("a", F.col("node").alias("b")).distinct()
        links = materialize(_verified(materialize(_alike(pairs, data, percent), "candidates"), rows, percent), "links")
        labels = _labels(links, scope)
        own = labels.withColumnRenamed("node", "a").withColumnRenamed("label", "first")
        lead = buckets.join(own, "a", "left").select("key", F.coalesce("first", "a").alias("lead"))
        named = members.select("key", "node").join(labels, "node", "left").select(
            "key", "node", F.coalesce("label", "node").alias("label"))
        named = named.join(lead, "key").select("key", "node", "label", (F.col("label") != F.col("lead")).alias("other"))
        named = materialize(named, "labelled")
        mixed, left = materialize(named.where("other").select("key").distinct(), "mixed", {"n": F.count(F.lit(1))})
        if left["n"]:
            found = _across(named.join(mixed, "key", "left_semi"), data, rows, percent)
            found, seen = materialize(found, "more_links", {"n": F.count(F.lit(1))})
            if seen["n"]:
                labels = _labels(links.union(found), scope)
        return nodes, labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: ``(doc_id, n_shingles, component_id, kept)``; component_id is the smallest id that
    can be reached over links, the document's own included; kept where that is its own."""
    rows = materialize(sketches(docs, doc_id, text, size), "sketches")
    nodes, labels = linked(rows, percent)
    named = nodes.join(labels, "node", "left").select("d1", "d2", F.coalesce("label", "node").alias("label"))
    first = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("c"))
    group = named.join(first, ["d1", "d2"])
    lows = group.groupBy("label").agg(F.min("low").alias("component_id"), F.sum("c").alias("c")).where("c > 1")
    # Only sets whose group has another document need a name; all others are their own.
    names = materialize(group.select("d1", "d2", "label").join(lows, "label").select("d1", "d2", "component_id"), "names")
    out = rows.select("doc_id", "n", "d1", "d2").join(names, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
