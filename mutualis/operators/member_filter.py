"""A Bloom filter over ids, built and tested in built-in expressions.

Pruning before a shuffle: rows whose id is surely not among the given ones are dropped in the scan.
The filter is an array of 64-bit words in one written row, handed to the scan as a scalar subquery; it
has two bits for each id, 16 to 32 bits of room, and at most ``MAX_BITS`` bits (16 MB). Where that would
leave less than four bits for each id there is no filter: the join that follows is exact either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, materialize

MAX_BITS = 1 << 27


def room(n: int) -> int:
    """Bits for ``n`` ids; 0 where too few are allowed."""
    bits = min(MAX_BITS, 1 << max(12, (16 * max(n, 1)).bit_length()))
    return bits if 4 * n <= bits else 0


def _places(id_: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(id_, F.lit(i)), F.lit(bits)) for i in range(2)]


def build(ids: DataFrame, column: str, n: int, scope: Scratch | None = None) -> DataFrame | None:
    """One written row ``(bits)`` for the ``n`` different ids in ``column``, or None."""
    bits = room(n)
    if not bits:
        return None
    at = ids.select(F.explode(F.array(*_places(F.col(column), bits))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b"))
    every = ids.sparkSession.range(bits // 64).select(F.col("id").alias("w")).join(words, "w", "left")
    row = every.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0)).alias("b")))).alias("l"))
    return materialize(row.select(F.transform("l", lambda x: x["b"]).alias("bits")), "member_bits", scope=scope)


def maybe(rows: DataFrame, column: str, bits: DataFrame | None, n: int) -> DataFrame:
    """``rows`` without those whose ``column`` is surely not among the ids."""
    if bits is None:
        return rows
    held = bits.scalar()
    for at in _places(F.col(column), room(n)):
        word = F.get(held, F.shiftright(at, 6).cast("int"))
        place = (at.bitwiseAND(F.lit(63))).cast("int")
        rows = rows.where(F.call_function("shiftrightunsigned", word, place).bitwiseAND(F.lit(1)) == 1)
    return rows
