"""Sorts and top-k (T1-T3) with a full tie-break, so equal keys give the same rows every run.

``orderBy(..).limit(k)`` plans as ``TakeOrderedAndProject``: each task keeps its own k best rows
and one task merges k rows per input partition. The whole input is never sorted or collected, and
the result stays a lazy DataFrame (no round trip through the driver).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(by: list[Column | str], ties: list[str]) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in by]
    return cols + [F.col(t).asc() for t in ties]


def sort_desc(df: DataFrame, col: str, ties: list[str] = ()) -> DataFrame:
    """Global sort on ``col`` descending, then ``ties`` ascending."""
    return df.orderBy(*_order([F.col(col).desc()], list(ties)))


def top_k(df: DataFrame, k: int, by: list[Column | str], ties: list[str] = ()) -> DataFrame:
    """The first ``k`` rows in the order ``by`` then ``ties`` ascending."""
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.orderBy(*_order(by, list(ties))).limit(k)


def sort_bounded(df: DataFrame, by: list[Column | str], ties: list[str] = ()) -> DataFrame:
    """Order the rows of at most k keys (after ``top_k``) in one partition.

    ``coalesce(1)`` is a narrow step, so this costs no range-partition shuffle. It is meant for a
    result that the caller will read as one ordered list: k keys with the few rows each of them has.
    Where keys can have many rows, use ``orderBy``.
    """
    return df.coalesce(1).sortWithinPartitions(*_order(by, list(ties)))
