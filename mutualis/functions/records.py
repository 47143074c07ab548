"""Record functions of the caller's own (U4, A1): map, flatMap, filter and reduce by key.

For logic that no built-in expression states. Records go to Python in Arrow batches; the function gets each
as a ``Row`` (fields by name or place, ``None`` for null) and runs once for each record, in the task that
holds it. Results are sent back in batches of at most ``BATCH`` records, whatever one record gives. Output
schemas are stated, and a result that does not fit one fails the job with the record in the message.
Empty inputs call nothing and give no record.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Ship these functions to the Python workers by value, so the workers need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH = 8192        # records in an Arrow batch that goes back
HELD = 1 << 16      # keys of which a task holds partial results at once
SALTS = 32          # shares that the partial results of a key are dealt to before the last merge

KeyTypes = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
            T.IntegralType, T.FractionalType, T.BinaryType)


def _schema(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def _rows(batch: pa.RecordBatch):
    names = batch.schema.names
    for values in zip(*[c.to_pylist() for c in batch.columns]):
        row = tuple.__new__(Row, values)  # as Row(*names)(*values) does, without its checks
        row.__fields__ = names
        yield row


def _fit(result, record, arrow: pa.Schema) -> tuple:
    """A result as its fields in order; given as such or as a dict."""
    if isinstance(result, dict):
        unknown = set(result) - set(arrow.names)
        if unknown:
            raise ValueError(f"fields {sorted(unknown)} are not in the stated schema, for {record}")
        result = tuple(result.get(n) for n in arrow.names)
    if not isinstance(result, (tuple, list)) or len(result) != len(arrow):
        raise ValueError(f"expected {len(arrow)} fields ({', '.join(arrow.names)}), got {result!r} for {record}")
    return result


def _batch(held: list, arrow: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*held), arrow)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([pa.field(f.name, f.type) for f in arrow]))


def _each(batches, fn: Callable, arrow: pa.Schema):
    """Arrow batches of all results of ``fn``."""
    held, width = [], len(arrow)
    for b in batches:
        for r in _rows(b):
            for x in fn(r):
                held.append(x if type(x) is tuple and len(x) == width else _fit(x, r, arrow))
                if len(held) == BATCH:
                    yield _batch(held, arrow)
                    held = []
    if held:
        yield _batch(held, arrow)


def flat_map_records(df: DataFrame, fn: Callable[[Row], Iterable], schema: T.StructType | str) -> DataFrame:
    """Every result that ``fn`` gives for a record, none or many, as a record of ``schema``."""
    schema = _schema(schema)
    arrow = to_arrow_schema(schema)

    def run(batches):
        yield from _each(batches, fn, arrow)

    return df.mapInArrow(run, schema)


def map_records(df: DataFrame, fn: Callable[[Row], tuple | dict], schema: T.StructType | str) -> DataFrame:
    """One record of ``schema`` for each record."""
    return flat_map_records(df, lambda r: (fn(r),), schema)


def filter_records(df: DataFrame, fn: Callable[[Row], bool]) -> DataFrame:
    """The records for which ``fn`` is true (null and other empty values are not); columns stay as they are."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array([bool(fn(r)) for r in _rows(b)], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _keyed(batch: pa.RecordBatch, n: int, real: list[int]):
    """(key, value) of each record: the first ``n`` columns and the next. Keys are the same where Spark groups
    them together: -0.0 equals 0.0, and NaN, in the ``real`` columns, is one object, which equals itself."""
    columns = [c.to_pylist() for c in batch.columns]
    for i in real:
        columns[i] = [math.nan if v is not None and v != v else v for v in columns[i]]
    return zip(zip(*columns[:n]), columns[n])


def _pieces(pairs: Iterable, arrow: pa.Schema):
    """Arrow batches of (key, value) pairs."""
    pairs = iter(pairs)
    while held := [(*k, v) for k, v in islice(pairs, BATCH)]:
        yield _batch(held, arrow)


def _merged(batches, fn: Callable, n: int, real: list[int], arrow: pa.Schema):
    """Arrow batches of the values merged by key, for at most ``HELD`` keys at once."""
    held, none = {}, object()
    for b in batches:
        for k, v in _keyed(b, n, real):
            before = held.get(k, none)
            if before is not none:
                held[k] = fn(before, v)
                continue
            if len(held) >= HELD:
                yield from _pieces(held.items(), arrow)
                held = {}
            held[k] = v
    yield from _pieces(held.items(), arrow)


def _merged_in_order(batches, fn: Callable, n: int, real: list[int], arrow: pa.Schema):
    """The same for records sorted by key: one key is held."""
    def results():
        last, total = None, None
        for b in batches:
            for k, v in _keyed(b, n, real):
                if k == last:
                    total = fn(total, v)
                    continue
                if last is not None:
                    yield last, total
                last, total = k, v
        if last is not None:
            yield last, total

    return _pieces(results(), arrow)


def reduce_by_key(df: DataFrame, keys: list[str] | str, value: str, fn: Callable, salts: int = SALTS) -> DataFrame:
    """``(keys.., value)``: the values of each key merged by ``fn(a, b)``, which must be associative and
    commutative. A key's single value is given as it is; a null value goes to ``fn`` as ``None``.

    Each task merges as it reads, holding results for at most ``HELD`` keys, so a hot key leaves it as a few
    partial results. These are merged in ``salts`` shares of a key, then sorted by key and merged as a
    stream: no step gathers a key's values. A null key is a key like others; keys are of plain types.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = df.select(*keys, value)
    for k in keys:
        if not isinstance(rows.schema[k].dataType, KeyTypes):
            raise TypeError(f"{k} cannot be a key: {rows.schema[k].dataType.simpleString()}")
    schema, n = rows.schema, len(keys)
    arrow = to_arrow_schema(schema)

    real = [i for i, k in enumerate(keys) if isinstance(schema[k].dataType, T.FractionalType)
            and not isinstance(schema[k].dataType, T.DecimalType)]

    def partial(batches):
        yield from _merged(batches, fn, n, real, arrow)

    def stream(batches):
        yield from _merged_in_order(batches, fn, n, real, arrow)

    once = rows.mapInArrow(partial, schema).withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(int(salts))))
    twice = once.repartition(*keys, "_share").drop("_share").mapInArrow(partial, schema)
    return twice.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(stream, schema)
