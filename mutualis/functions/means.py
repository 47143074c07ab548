"""Means that do not depend on the order of addition (A3, A4).

A sum of doubles depends on the order in which tasks and partial results are added, so near-equal means
may rank differently in two runs. Here each value is cut into a whole number and parts of 20
bits after the point, each part is summed as a whole number, and the sums are put together at the end in
one fixed way. The parts hold every bit of a value down to 2^-60, so equal sets of values have equal
means, however they are partitioned; sums that doubles hold exactly give the same mean as ``avg``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PART = float(1 << 20)
_LARGE = float(1 << 20)  # sums of whole numbers up to this stay exact over 2^43 rows


def exact_mean(c: Column | str) -> Column:
    """Aggregate: the mean of the values that are not null (null where there is none).

    A NaN, an infinity or a magnitude above 2^20 in the group makes it a plain ``avg``."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    # NaN is larger than any number, so it is no plain value here.
    plain = F.abs(x) <= F.lit(_LARGE)
    rest, sums = F.when(plain, x), []
    for _ in range(4):
        whole = F.floor(rest)
        sums.append(F.sum(whole))
        rest = (rest - whole) * F.lit(_PART)
    total = F.lit(0.0)
    for s in reversed(sums):  # smallest parts first
        total = total / F.lit(_PART) + s.cast("double")
    return F.when(F.count(F.when(~plain, 1)) > 0, F.avg(x)).otherwise(total / F.nullif(F.count(x), F.lit(0)))
