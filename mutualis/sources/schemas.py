"""Typed schemas of the four line formats (SC6).

The inputs are header-less text, so names and types are fixed here rather than inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and separators of the input and output line formats.
PROFILE_COLUMNS = ["userid", "firstname", "lastname", "address", "city", "state", "zipcode",
                   "country", "username", "dob"]
ADJACENCY_COLUMNS = ["userid", "friend_list"]
BUSINESS_COLUMNS = ["businessid", "address", "categories"]
REVIEW_COLUMNS = ["reviewid", "userid", "businessid", "stars"]
PROFILE_SEP = ","
ADJACENCY_SEP = "\t"
FRIEND_SEP = ","
RECORD_SEP = "::"
PAIR_KEY_SEP = ", "
OUT_SEP = "\t"
DEFAULT_ADDRESS_PATTERN = "Stanford, CA"
DEFAULT_TOP_K = 10

PROFILE_SCHEMA = T.StructType(
    [T.StructField("userid", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in PROFILE_COLUMNS[1:]])

ADJACENCY_SCHEMA = T.StructType([
    T.StructField("userid", T.LongType()),
    T.StructField("friend_list", T.ArrayType(T.LongType())),
])

EDGE_SCHEMA = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
])

BUSINESS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in BUSINESS_COLUMNS])

REVIEW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in REVIEW_COLUMNS[:3]]
    + [T.StructField("stars", T.DoubleType())])

PAIR_COUNT_SCHEMA = T.StructType([
    T.StructField("id1", T.LongType()),
    T.StructField("id2", T.LongType()),
    T.StructField("n", T.LongType()),
])
