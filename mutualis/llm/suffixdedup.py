"""Suffix-array deduplication: passages of ``min_words`` words or more that occur more than once.

A sparse suffix array: of every document only the suffixes are retained that start at minimiser
positions, chosen by content (the smallest hash of KEY words among the places where a passage's
first HEAD words could hold it), so that equal passages retain suffixes at the same places. They are
sorted (``_array``): by the hash of their first words, as many as every repeat through a suffix must
share with it, and ties by the hash of all that such a repeat can touch, then by place. In that order
suffixes with a common prefix of that length are neighbours; one whose prefix is neither that of the
suffix before it nor of the one after it is dropped. The rest are extended to the left and to the right: first by everything that any
repeat through the suffix can touch (suffixes equal in all of it are one class), then, for one
suffix of each class, word by word, as the hashes of the passages through it. So the result is
exact (up to 64-bit hashes): a passage of ``min_words`` words is repeated if it occurs at two
places in the table, and its first place, by (doc_id, text hash, position), is the one to keep.

The array lies in range partitions of the whole order, so a prefix that a third of all suffixes share
takes many partitions; a task compares neighbours as a stream, and the first and last suffix of every
partition are matched with those of the others. Classes are aggregated on the map side; no list of a
passage's occurrences is ever built, and copies are not paired with each other.

Words are runs outside ASCII white space, compared as they are. Null and short texts have no
passage. Rows that repeat both id and text are one document. Null ids order first. An empty table
gives no rows. A very long text is one chunk of a task's memory (its words' hashes, 8 bytes each). Other
columns of the table, whatever their names, are carried by ``drop_repeats`` and not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import current_scope, materialize, scratch_scope
from .textcore import TEXT_NAME, Hasher, mix, text_chunks, text_name

MIN_WORDS = 50
KEY = 8     # words hashed to choose positions
HEAD = 40   # words at the front of a passage within which its suffix is retained
_AT = (1 << 24) - 1


def _sizes(min_words: int) -> tuple[int, int, int]:
    """(words hashed, width of the choice, words of the prefix) for a passage length."""
    head = max(1, min(HEAD, min_words * 4 // 5))
    key = max(1, min(KEY, head))
    return key, head - key + 1, min_words - (head - key)


def retained(hasher: Hasher, h: np.ndarray, end: np.ndarray, min_words: int):
    """The retained suffixes of a chunk: (first passage, last passage, position, prefix hash, hash
    of all words any passage through it has). Passages are numbered by their first word."""
    key, width, prefix_words = _sizes(min_words)
    n = len(h)
    at = np.flatnonzero(np.arange(n) + min_words <= end)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = hasher.word_prefix(h)
    g = hasher.grams(prefix, np.arange(n - key + 1), key)
    # Hash above, position below: the smallest is the leftmost of equal hashes.
    low = (g & ~np.uint64(_AT)) | (np.arange(len(g), dtype=np.uint64) & np.uint64(_AT))
    span = 1
    while 2 * span <= width:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    place = at + (((low[at] & np.uint64(_AT)).astype(np.int64) - at) & _AT)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1])
    start = np.flatnonzero(new)
    lo, place = at[start], place[start]
    hi = at[np.append(start[1:], len(at)) - 1]
    whole = mix(hasher.grams(prefix, lo, hi - lo + min_words) + (hi - lo).astype(np.uint64))
    return lo, hi, place, hasher.grams(prefix, place, prefix_words), whole


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), text_name(text).alias("t"), F.col(text).alias("text"))


def _suffixes(rows: DataFrame, min_words: int) -> DataFrame:
    """``(doc_id, t, lo, hi, prefix, whole)`` of every retained suffix."""
    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for a, b, data, bounds in text_chunks(batch.column("text")):
                _, _, row, h = hasher.tokens(data, bounds)
                first = np.zeros(b - a + 1, np.int64)
                np.cumsum(np.bincount(row, minlength=b - a), out=first[1:])
                lo, hi, _, prefix, whole = retained(hasher, h, first[1:][row], min_words)
                of = row[lo]
                took = pa.array(of + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(took), batch.column("t").take(took),
                     pa.array((lo - first[of]).astype(np.int32)), pa.array((hi - first[of]).astype(np.int32)),
                     pa.array(prefix.view(np.int64)), pa.array(whole.view(np.int64))],
                    names=["doc_id", "t", "lo", "hi", "prefix", "whole"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, t {TEXT_NAME}, lo int, hi int, prefix long, whole long")


_ORDER = ["prefix", "whole", "doc_id", "t", "lo", "hi"]


def _array(suffixes: DataFrame) -> DataFrame:
    """The sorted suffixes that share their prefix with a neighbour in their partition, and the first and
    last one of every partition: ``(*_ORDER, edge, alone)``. edge: first or last; alone: no neighbour in the
    partition shares the prefix."""
    def run(batches):
        pending = before = None  # the row that waits for its next one, and the prefix of the row before it

        def rows(batch, last):
            prefix = batch.column("prefix").to_numpy()
            shared = np.zeros(len(prefix) + 1, bool)  # with the row before
            shared[0] = before is not None and prefix[0] == before
            shared[1:-1] = prefix[1:] == prefix[:-1]
            edge = np.zeros(len(prefix), bool)
            edge[0], edge[-1] = before is None, last
            alone = ~(shared[:-1] | shared[1:])
            ready = np.arange(len(prefix) if last else len(prefix) - 1)
            took = ready[(~alone | edge)[ready]]
            return pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(took)).columns, pa.array(edge[took]), pa.array(alone[took])],
                names=[*_ORDER, "edge", "alone"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if pending is not None:
                batch = pa.Table.from_batches([pending, batch]).combine_chunks().to_batches()[0]
            if batch.num_rows > 1:
                yield rows(batch, False)
                before = batch.column("prefix")[batch.num_rows - 2].as_py()
            pending = batch.slice(batch.num_rows - 1)
        if pending is not None:
            yield rows(pending, True)

    array = suffixes.select(*_ORDER).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    kinds = dict(array.dtypes)
    return array.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in _ORDER) + ", edge boolean, alone boolean")


def _neighbours(suffixes: DataFrame, scope) -> DataFrame:
    """The suffixes that share their prefix with a neighbour, as ``(whole, p)``. Equal prefixes in different
    partitions stand at these partitions' edges, which are at most two rows of each."""
    array = materialize(_array(suffixes), "suffix_array", scope=scope)
    edges = array.where("edge").groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("prefix")
    across = array.where("alone").join(materialize(edges, "array_edges", scope=scope), "prefix", "left_semi")
    return array.where("not alone").unionByName(across).select("whole", F.struct("doc_id", "t", "lo", "hi").alias("p"))


def _passages(rows: DataFrame, ranges: DataFrame, min_words: int) -> DataFrame:
    """``(passage, doc_id, t, at)`` for the passages of some ranges of documents."""
    per_doc = ranges.groupBy("doc_id", "t").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_id", "t": "_t"})
    joined = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t"))).select(
        "doc_id", "t", "text", "ranges")

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            ranges = batch.column("ranges")
            offsets = ranges.offsets.to_numpy()
            lows, highs = (ranges.values.field(i).to_numpy() for i in range(2))
            for a, b, data, bounds in text_chunks(batch.column("text")):
                _, _, row, h = hasher.tokens(data, bounds)
                first = np.zeros(b - a + 1, np.int64)
                np.cumsum(np.bincount(row, minlength=b - a), out=first[1:])
                lo, hi = lows[offsets[a]:offsets[b]].astype(np.int64), highs[offsets[a]:offsets[b]].astype(np.int64)
                of = np.repeat(np.arange(b - a), np.diff(offsets[a:b + 1]))
                size = hi - lo + 1
                at = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                of = np.repeat(of, size)
                passage = hasher.grams(hasher.word_prefix(h), first[of] + at, min_words)
                took = pa.array(of + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(passage.view(np.int64)), batch.column("doc_id").take(took),
                     batch.column("t").take(took), pa.array(at.astype(np.int32))],
                    names=["passage", "doc_id", "t", "at"])

    kind = dict(rows.dtypes)["doc_id"]
    return joined.mapInArrow(run, f"passage long, doc_id {kind}, t {TEXT_NAME}, at int")


def repeated_ranges(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, t, lo, hi, earlier_id, later)``: the passages that start at words lo to hi occur
    again. later: each has an earlier place, and earlier_id is a document that holds it. A passage
    that is in no later range of its document is at its first place."""
    rows = _documents(docs, doc_id, text)
    held = current_scope()
    with scratch_scope(docs.sparkSession):
        suffixes = materialize(_suffixes(rows, min_words), "suffixes")
        live = _neighbours(suffixes, held)
    classes = materialize(live.groupBy("whole").agg(F.min("p").alias("low"), F.max("p").alias("high")), "suffix_classes")
    # Within a class all passages agree: every member but the first is a later place of all its
    # passages, and only the first needs to be compared with other classes.
    copied = classes.where("low <> high").select("whole", "low")
    members = live.join(copied, "whole").where("p <> low").select(
        "p.*", F.col("low.doc_id").alias("earlier_id"), F.lit(True).alias("later"))
    no_id = F.lit(None).cast(dict(rows.dtypes)["doc_id"]).alias("earlier_id")
    firsts = copied.select("low.*", no_id, F.lit(False).alias("later"))
    passages = materialize(_passages(rows, classes.select("low.*"), min_words), "passages")
    place = F.struct("doc_id", "t", "at")
    again = passages.groupBy("passage").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high")
    again = materialize(again.select("passage", "low"), "repeated_passages")
    by_passage = passages.join(again, "passage").select(
        "doc_id", "t", F.col("at").alias("lo"), F.col("at").alias("hi"), F.col("low.doc_id").alias("earlier_id"),
        (place != F.col("low")).alias("later"))
    return members.union(firsts).union(by_passage)


def _merged(ranges: DataFrame, min_words: int) -> DataFrame:
    """Per document the united word spans: ``(doc_id, t, spans array<struct<start, end,
    earlier_id, later>>)``. Spans of later places come first in their claim on words."""
    packed = ranges.groupBy("doc_id", "t").agg(
        F.sort_array(F.collect_set(F.struct("lo", "hi", "earlier_id", "later"))).alias("r"))  # same result every run
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("earlier_id", ranges.schema["earlier_id"].dataType),
                         T.StructField("later", T.BooleanType())])
    schema = T.StructType([packed.schema["doc_id"], packed.schema["t"], T.StructField("spans", T.ArrayType(span))])
    spans_type = to_arrow_type(T.ArrayType(span))

    def unite(at, earlier):
        """Spans of the passages at sorted places; ``earlier`` names the document of a later one."""
        if not len(at):
            return []
        start = np.flatnonzero(np.append(True, at[1:] > at[:-1] + min_words))
        stop = at[np.append(start[1:], len(at)) - 1] + min_words
        return [{"start": int(x), "end": int(y), "earlier_id": earlier(i) if earlier else None,
                 "later": earlier is not None}
                for x, y, i in zip(at[start], stop, start)]

    def places(lo, hi):
        """Different places of some ranges, and the range of each."""
        size = hi - lo + 1
        at = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at, which = np.unique(at, return_index=True)
        return at, np.repeat(np.arange(len(lo)), size)[which]

    def run(batches):
        for batch in batches:
            r = batch.column("r")
            offsets, flat = r.offsets.to_numpy(), r.values
            lo, hi = (flat.field(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
            ids, later = flat.field("earlier_id"), flat.field("later").to_numpy(zero_copy_only=False)
            out = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                mine = np.arange(a, b)
                of = mine[later[a:b]]
                at, which = places(lo[of], hi[of])
                spans = unite(at, lambda i: ids[int(of[which[i]])].as_py())
                rest = mine[~later[a:b]]
                first, _ = places(lo[rest], hi[rest])
                out.append(spans + unite(np.setdiff1d(first, at, assume_unique=True), None))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array(out, spans_type)],
                                             names=["doc_id", "t", "spans"])

    return packed.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document that holds a repeated passage: ``(doc_id, t, spans)``.

    Spans are word ranges [start, end). ``later``: the words lie in passages that occur at an
    earlier place, earlier_id being a document that holds the span's first passage; the other spans
    hold passages of which this is the first place. Both kinds may overlap."""
    held = current_scope()
    with scratch_scope(docs.sparkSession):
        ranges = repeated_ranges(docs, doc_id, text, min_words)
        return materialize(_merged(ranges, min_words), "repeated_spans", scope=held)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; the white space before the first of them stays."""
    data = text.encode()
    starts, _, _ = Hasher().spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    out, at = [], 0
    for a, b in sorted(spans):
        out.append(data[at:max(at, int(starts[a]))])
        at = max(at, int(starts[b]) if b < len(starts) else len(data))
    return b"".join([*out, data[at:]]).decode()


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every repeated passage cut but at its first place; a document of which no word
    is left is dropped. A column ``n_chars`` is brought up to date."""
    spans = repeated_spans(docs, doc_id, text, min_words)
    later = spans.select(F.col("doc_id").alias("cut_id"), F.col("t").alias("cut_t"), F.expr(
        "transform(filter(spans, s -> s.later), s -> struct(s.start, s.end))").alias("spans")).where("size(spans) > 0")
    packed = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"),
                         text_name(text).alias("t"))
    joined = packed.join(later, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("t") == F.col("cut_t")), "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([x if x is None or s is None else cut_spans(x, [(i["start"], i["end"]) for i in s])
                          for x, s in zip(texts, lists)], dtype=object)

    touched, old = F.col("spans").isNotNull(), F.col("row")[text]
    out = joined.withColumn("new", F.when(touched, cut(F.when(touched, old), "spans")).otherwise(old))
    out = out.where(~touched | F.col("new").rlike(r"[^\x20\x09-\x0D]"))
    kinds = dict(docs.dtypes)

    def column(c: str):
        if c == text:
            return F.col("new").alias(c)
        if c == "n_chars":
            return F.when(touched, F.char_length("new")).otherwise(F.col("row")[c]).cast(kinds[c]).alias(c)
        return F.col("row")[c].alias(c)

    return out.select(*[column(c) for c in docs.columns])
