"""Text-line sources (SC1-SC5): one record per line, no header, split into typed columns.

Every parser is a projection of built-in expressions over ``spark.read.text``: it runs inside
whole-stage codegen, splits with the files, and never passes rows through Python. Parsing is strict
on any session: bad numbers and records with too few fields fail the job, as ``int()`` and indexing
would; ``permissive=True`` turns both into null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas as S


def _literal_sep(sep: str) -> str:
    """``split`` takes a Java regex; quote the separator so it is matched as text."""
    return "\\Q" + sep + "\\E"


def _cast(c: Column, dtype: str, permissive: bool) -> Column:
    """Text → ``dtype``. Bad text is null (permissive) or fails the job, whether or not the session
    has ANSI casts on."""
    good = c.try_cast(dtype)
    if permissive:
        return good
    return F.when(good.isNull() & c.isNotNull(), F.raise_error(
        F.concat(F.lit(f"not a {dtype}: "), F.substr(c, F.lit(1), F.lit(80)))).cast(dtype)).otherwise(good)


def _field(parts: Column, i: int, permissive: bool) -> Column:
    """Field ``i`` of a split record. A record too short for it has null there (permissive) or fails
    the job."""
    got = F.get(parts, F.lit(i))
    if permissive:
        return got
    return F.when(F.size(parts) <= i, F.raise_error(
        F.concat(F.lit(f"record without field {i + 1}: "), F.substr(F.array_join(parts, "|"), F.lit(1), F.lit(80))))
        .cast("string")).otherwise(got)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SC1: text files → ``value STRING``, one row per line."""
    return spark.read.text(path)


def _records(lines: DataFrame) -> DataFrame:
    """Blank (or whitespace-only) lines are not records."""
    return lines.where(F.trim(F.col("value")) != F.lit(""))


def split_fields(value: Column, sep: str) -> Column:
    """Split on a literal separator, keeping trailing empty fields (limit -1)."""
    return F.split(value, _literal_sep(sep), -1)


def id_list(text: Column, sep: str = S.FRIEND_SEP, permissive: bool = False) -> Column:
    """``"3,4,"`` → ``[3, 4]``: split, drop blank tokens (F6), cast each id."""
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), _literal_sep(sep), -1),
                      lambda t: F.trim(t) != F.lit(""))
    return F.transform(tokens, lambda t: _cast(t, "bigint", permissive))


def parse_profiles(lines: DataFrame, permissive: bool = False) -> DataFrame:
    """SC2: ``id,first,last,address,city,state,zip,country,username,dob`` → typed profile."""
    parts = split_fields(F.col("value"), S.PROFILE_SEP)
    cols = [_cast(_field(parts, 0, permissive), "bigint", permissive).alias("userid")]
    cols += [_field(parts, i, permissive).alias(name) for i, name in enumerate(S.PROFILE_COLUMNS[1:], start=1)]
    return _records(lines).select(*cols)


def parse_adjacency(lines: DataFrame, permissive: bool = False) -> DataFrame:
    """SC3: ``user<TAB>f1,f2,..`` → ``(userid BIGINT, friend_list ARRAY<BIGINT>)``.

    Blank tokens (trailing comma, empty list) are dropped; a repeated friend stays repeated here
    and is removed when edges are made distinct.
    """
    parts = split_fields(F.col("value"), S.ADJACENCY_SEP)
    return _records(lines).select(
        _cast(_field(parts, 0, permissive), "bigint", permissive).alias("userid"),
        id_list(_field(parts, 1, permissive), permissive=permissive).alias("friend_list"))


def parse_records(lines: DataFrame, names: list[str], sep: str = S.RECORD_SEP,
                  permissive: bool = False) -> DataFrame:
    """SC4: multi-character separated record → one string column per name.

    ``split`` keeps an empty last field as ``''`` (the CSV reader would make it null).
    """
    parts = split_fields(F.col("value"), sep)
    return _records(lines).select(*[_field(parts, i, permissive).alias(n) for i, n in enumerate(names)])


def parse_businesses(lines: DataFrame, permissive: bool = False) -> DataFrame:
    """``businessid::address::categories`` → three strings."""
    return parse_records(lines, S.BUSINESS_COLUMNS, permissive=permissive)


def parse_reviews(lines: DataFrame, permissive: bool = False) -> DataFrame:
    """``reviewid::userid::businessid::stars`` → three strings and ``stars DOUBLE``."""
    raw = parse_records(lines, S.REVIEW_COLUMNS, permissive=permissive)
    return raw.withColumn("stars", _cast(F.col("stars"), "double", permissive))


def inline_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | list[str]) -> DataFrame:
    """SC5: a small literal table (parameters, fixtures). Data-sized inputs never go this way."""
    return spark.createDataFrame(list(rows), schema)


def named(df: DataFrame, names: list[str]) -> DataFrame:
    """SC6: positional columns → the given names."""
    return df.toDF(*names)
