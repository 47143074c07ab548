"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens, raised to an exponent and normalised. The exponent is
bisected so that either the weights reach a target entropy or no source repeats more than
``max_repeats`` times. The weights are realised as block permutations within a token budget: a
source whose weight asks for r times its tokens gives floor(r) whole permutations of its documents
(each in an order of its own, by a seeded hash) and the part of one more that fits the remaining
budget: the longest prefix whose tokens do not exceed it. Without a budget, the budget is the
smallest one in which every document occurs at least once.

Nothing but one row per source reaches the driver. The end of a partial permutation is one
``(hash, doc_id)`` per source, found from token sums over HASH_BUCKETS ranges of the hash and the
running sum inside the one range where the budget ends; so which documents are taken is a filter on
the documents, and a source with any share of the rows is spread over all tasks.

Tokens are words. Null text has none. A null source is a source of its own. Sources without any
token have weight 0 and give each document once. Repeated rows are documents like any other and
are taken together. Documents without tokens follow their hash like the others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import current_scope, materialize, scratch_scope

MAX_REPEATS = 2.0
SEED = 20
HASH_BITS = 12          # ranges of the hash: 2^12 for each source and permutation
BLOCK_TOKENS = 1 << 20  # tokens of a block of the mix
_WORD = r"[^\x20\x09-\x0D]+"


def weights_at(tokens: list[int], exponent: float) -> list[float]:
    """Normalised token shares to the power of ``exponent`` (0 for a source without tokens)."""
    total = sum(tokens)
    raw = [(n / total) ** exponent if n else 0.0 for n in tokens]
    return [x / sum(raw) for x in raw] if total else [0.0] * len(tokens)


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def ratios(tokens: list[int], weights: list[float], budget: float | None) -> list[float]:
    """How often each source is passed over: weight x budget / tokens."""
    some = [w / n for n, w in zip(tokens, weights) if n]
    if not some:
        return [1.0] * len(tokens)
    budget = 1 / min(some) if budget is None else budget
    return [w * budget / n if n else 1.0 for n, w in zip(tokens, weights)]


def exponent_for(tokens: list[int], target_entropy: float | None = None, max_repeats: float | None = None,
                 budget: float | None = None, steps: int = 80) -> float:
    """The exponent in [0, 1] nearest 0 (flattest weights) that keeps the repetition limit, or the
    one in [0, 64] whose weights have the target entropy (the nearest bound if none has)."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give a target entropy or a repetition limit")

    def flat_enough(a: float) -> bool:  # holds for large exponents
        w = weights_at(tokens, a)
        if target_entropy is not None:
            return entropy(w) <= target_entropy
        return max(ratios(tokens, w, budget), default=1.0) <= max_repeats + 1e-9

    low, high = 0.0, 64.0 if target_entropy is not None else 1.0
    if flat_enough(low):
        return low
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if flat_enough(mid) else (mid, high)
    return high


def _order(copy: Column, row_hash: Column, seed: int) -> Column:
    """The place of a document in a permutation, as an unsigned hash in a signed long."""
    return F.xxhash64(F.lit(seed), copy, row_hash)


def _bucket(order: Column) -> Column:
    return F.shiftrightunsigned(order.bitwiseXOR(F.lit(-(1 << 63))), 64 - HASH_BITS)


def _plan(rows: DataFrame, target_entropy, max_repeats, budget, seed) -> DataFrame:
    """One row per source: ``source, tokens, weight, ratio, whole, cut_hash, cut_id``; of the
    permutation numbered ``whole`` the rows below (cut_hash, cut_id) are taken (null: none)."""
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()
    sums.sort(key=lambda r: (r["source"] is not None, r["source"]))
    tokens = [int(r["tokens"]) for r in sums]
    a = exponent_for(tokens, target_entropy, max_repeats, budget)
    w = weights_at(tokens, a)
    r = ratios(tokens, w, budget)
    # A ratio within rounding of a whole number is that number.
    r = [float(round(x)) if abs(x - round(x)) < 1e-9 else x for x in r]
    table = [(s["source"], n, a, wi, x, int(x), int((x - int(x)) * n)) for s, n, wi, x in zip(sums, tokens, w, r)]
    plan = spark.createDataFrame(
        table, "source string, tokens long, exponent double, weight double, ratio double, whole int, rest long")
    # Written, so that the planner knows its size: it broadcasts it while it is small, and AQE splits
    # a hot source in the join where it is not.
    plan = materialize(plan.coalesce(1), "mix_weights")
    part = rows.withColumnRenamed("source", "_source").join(
        plan.select("source", "whole", "rest").where("rest > 0"), F.col("_source").eqNullSafe(F.col("source")))
    part = part.withColumn("order", _order(F.col("whole"), F.col("row_hash"), seed)).select(
        F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("no_source"),
        "rest", "order", "doc_id", "tokens", _bucket(F.col("order")).alias("bucket"))
    sizes = part.groupBy("source", "no_source", "rest", "bucket").agg(F.sum("tokens").alias("n"))
    ends = sizes.selectExpr(
        "*", "sum(n) over (partition by source, no_source order by bucket) as upto").where("upto > rest")
    ends = ends.groupBy("source", "no_source").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")), "bucket").alias("e"))
    ends = materialize(ends.select("source", "no_source", "e.bucket", "e.before"), "cut_buckets")
    inside = part.join(ends, ["source", "no_source", "bucket"])
    inside = inside.selectExpr("*", "before + sum(tokens) over (partition by source, no_source order by `order`, doc_id) as upto")
    cut = inside.where("upto > rest").groupBy("source", "no_source").agg(
        F.min(F.struct("order", "doc_id")).alias("cut"))
    cut = cut.select(F.when(~F.col("no_source"), F.col("source")).alias("_source"), F.col("cut.order").alias("cut_hash"),
                     F.col("cut.doc_id").alias("cut_id"))
    return plan.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _taken(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``rows`` (with source, doc_id, row_hash) times the copies taken; adds copy and order."""
    p = plan.withColumnRenamed("source", "_plan_source").withColumnRenamed("tokens", "source_tokens")
    out = rows.join(p, F.col("source").eqNullSafe(F.col("_plan_source")))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    out = out.withColumn("order", _order(F.col("copy"), F.col("row_hash"), seed))
    below = (F.col("order") < F.col("cut_hash")) | ((F.col("order") == F.col("cut_hash")) & (
        F.coalesce(F.col("doc_id") < F.col("cut_id"), F.col("doc_id").isNull() & F.col("cut_id").isNotNull())))
    # Without a cut, the rest of the budget holds all of the permutation (if there is a rest).
    all_fit = F.col("cut_hash").isNull() & (F.col("rest") > 0)
    return out.where((F.col("copy") < F.col("whole")) | all_fit | F.coalesce(below, F.lit(False)))


def _rows(docs: DataFrame, doc_id: str, source: str, text: str) -> list[Column]:
    raw = F.coalesce(F.col(text), F.lit(""))
    return [F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            F.regexp_count(raw, F.lit(_WORD)).cast("long").alias("tokens"),
            F.xxhash64(F.col(doc_id), F.col(text)).alias("row_hash")]


def mix_documents(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
                  budget: float | None = None, seed: int = SEED, block_tokens: int = BLOCK_TOKENS,
                  doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with its columns only.

    Their order is the mix's: partitions (and the files written of them) hold consecutive blocks of
    ``mix_schedule``, and a partition its rows by block, then by a hash of source, copy and place."""
    held = current_scope()
    with scratch_scope(docs.sparkSession):
        rows = materialize(docs.select(*_rows(docs, doc_id, source, text)), "mix_rows")
        plan = materialize(_plan(rows, target_entropy, max_repeats, budget, seed), "mix_plan", scope=held)
        sums = materialize(_sums(_with_bucket(_taken(rows, plan, seed))), "mix_sums", scope=held)
    whole = F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row")
    taken = _with_bucket(_taken(docs.select(whole, *_rows(docs, doc_id, source, text)), plan, seed))
    placed = _placed(taken, sums, block_tokens).withColumn("dealt", F.xxhash64("s", "copy", "order"))
    return placed.repartitionByRange("block", "dealt").sortWithinPartitions("block", "dealt").select("_row.*")


_PART = ["s", "no_source", "copy", "bucket"]


def _with_bucket(taken: DataFrame) -> DataFrame:
    return taken.withColumn("s", F.coalesce("source", F.lit(""))).withColumn("no_source", F.col("source").isNull()).withColumn(
        "bucket", _bucket(F.col("order")))


def _sums(taken: DataFrame) -> DataFrame:
    """Tokens of a source's copy in each range of the order."""
    return taken.groupBy(*_PART).agg(F.sum("tokens").alias("n"))


def _placed(taken: DataFrame, sums: DataFrame, block_tokens: int) -> DataFrame:
    """``taken`` with ``start_token`` and ``block``."""
    before = sums.selectExpr(*_PART, "sum(n) over (partition by s, no_source, copy order by bucket) - n as before")
    placed = taken.selectExpr("*", f"sum(tokens) over (partition by {', '.join(_PART)} order by `order`, doc_id "
                              "rows between unbounded preceding and current row) - tokens as inside")
    placed = placed.join(before, _PART).withColumn(
        "start_token", F.col("copy") * F.col("source_tokens") + F.col("before") + F.col("inside"))
    per_block = F.col("weight") * block_tokens
    return placed.withColumn(
        "block", F.when(per_block > 0, F.floor(F.col("start_token") / per_block)).otherwise(0).cast("long"))


def mix_schedule(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
                 budget: float | None = None, seed: int = SEED, block_tokens: int = BLOCK_TOKENS,
                 doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per occurrence in the mix: ``(doc_id, source, n_tokens, exponent, weight, ratio,
    copy, start_token, block)``. start_token is where the document starts in its source's stream;
    block is the block of the mix it starts in: a block takes weight x block_tokens tokens of every
    source, so every block holds the sources at their weights."""
    held = current_scope()
    with scratch_scope(docs.sparkSession):
        rows = materialize(docs.select(*_rows(docs, doc_id, source, text)), "mix_rows")
        plan = materialize(_plan(rows, target_entropy, max_repeats, budget, seed), "mix_plan")
        taken = _with_bucket(_taken(rows, plan, seed)).select(
            "doc_id", "source", "s", "no_source", "tokens", "source_tokens", "exponent", "weight", "ratio", "copy", "order",
            "bucket")
        taken = materialize(taken, "mix_taken", scope=held)
    return _placed(taken, _sums(taken), block_tokens).select(
        "doc_id", "source", F.col("tokens").alias("n_tokens"), "exponent", "weight", "ratio", "copy",
        F.col("start_token").cast("long").alias("start_token"), "block")
