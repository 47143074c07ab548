"""Pair and list expressions (P12, F3, A2, X6-X8) for row-level use.

The graph jobs at scale work on edge rows (``operators.mutual``); these are the per-row forms for
inputs that already carry both lists in one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_pair(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """The pair key with the smaller id first."""
    return F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b))


def is_reciprocal(u1: Column | str, list1: Column | str, u2: Column | str, list2: Column | str) -> Column:
    """each user is on the other's list (boolean; null lists count as empty)."""
    return (F.coalesce(F.array_contains(_c(list2), _c(u1)), F.lit(False))
            & F.coalesce(F.array_contains(_c(list1), _c(u2)), F.lit(False)))


def shared_count(list1: Column | str, list2: Column | str,
                 exclude: list[Column | str] | None = None) -> Column:
    """Number of distinct ids on both lists, minus the ``exclude`` ids (BIGINT)."""
    common = F.array_intersect(_c(list1), _c(list2))
    if exclude:
        common = F.array_except(common, F.array(*[_c(x) for x in exclude]))
    return F.size(common).cast("bigint")
