"""The scalar-UDF surface (U1-U3): user functions with a stated return type.

The jobs never need these (every original helper has a built-in equivalent, see ``pairs`` and
``lines``); they exist for callers who bring Python logic. All are Arrow or Pandas UDFs, so rows cross to
Python in Arrow batches, not one at a time; only ``scalar_udf`` calls its function for each value.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import OUT_SEP

# Ship these functions to the Python workers by value, so the workers need not import this package
# (it may not be on their path on a cluster).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _codes(*arrays: pa.Array) -> list[np.ndarray]:
    """Equal values of the arrays as equal numbers, null as -1."""
    both = pa.chunked_array([a.cast(arrays[0].type) for a in arrays]).combine_chunks().dictionary_encode()
    code = both.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(code, np.cumsum([len(a) for a in arrays])[:-1])


def _items(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of every list item, and the items; null lists have none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), pc.list_flatten(lists)


def _per_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n)


@F.arrow_udf(T.IntegerType())
def reciprocal_udf(u1: pa.Array, list1: pa.Array, u2: pa.Array, list2: pa.Array) -> pa.Array:
    """1 when each user is on the other's list, else 0. Null users, lists and items match nothing."""
    (r1, v1), (r2, v2), n = _items(list1), _items(list2), len(u1)
    a, x, b, y = _codes(u1, v1, u2, v2)
    both = (_per_row(r1[(x == b[r1]) & (x >= 0)], n) > 0) & (_per_row(r2[(y == a[r2]) & (y >= 0)], n) > 0)
    return pa.array(both.astype(np.int32))


@F.arrow_udf(T.IntegerType())
def shared_count_udf(list1: pa.Array, list2: pa.Array, id1: pa.Array, id2: pa.Array) -> pa.Array:
    """Size of the set intersection of two lists, the two pair members left out. Null lists are
    empty, null items are none.

    The items of a batch are sorted by row and value, each list's repeats dropped; a value that is
    there twice then is on both lists."""
    (r1, v1), (r2, v2), n = _items(list1), _items(list2), len(list1)
    x, y, a, b = _codes(v1, v2, id1, id2)
    width = max(int(max(c.max(initial=0) for c in (x, y, a, b))) + 1, 1)
    sides = []
    for row, code in ((r1, x), (r2, y)):
        some = (code >= 0) & (code != a[row]) & (code != b[row])
        sides.append(np.unique(row[some] * width + code[some]))
    met = np.sort(np.concatenate(sides))
    return pa.array(_per_row(met[1:][met[1:] == met[:-1]] // width, n).astype(np.int32))


@F.pandas_udf(T.StringType())
def _join_text(*series: pd.Series) -> pd.Series:
    parts = [s.where(s.notna(), "None").astype(object) for s in series]
    out = parts[0]
    for s in parts[1:]:
        out = out + OUT_SEP + s
    return out


def tab_line_udf(*cols):
    """Fields joined by tabs, ``None`` for null, as the original helpers give. Returns STRING.

    Each field becomes text before it leaves the JVM, so a row's text does not depend on the rows it
    shares a batch with (a batch with a null would turn whole numbers into floats)."""
    return _join_text(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


@F.pandas_udf(T.FloatType())
def to_float_udf(text: pd.Series) -> pd.Series:
    """Text → 32-bit float (bad text fails, as ``float()`` does)."""
    return text.astype("float64").astype("float32")


def scalar_udf(fn, return_type: T.DataType):
    """Wrap a per-value Python function as a vectorized UDF with the given return type."""
    @F.pandas_udf(return_type)
    def _apply(*series: pd.Series) -> pd.Series:
        return pd.Series([fn(*vals) for vals in zip(*series)])
    return _apply
