"""The corpus pipeline: five operators of ``mutualis.llm`` over the documents, one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet to
the shared folder and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``; the last returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mutualis.llm import bpe, mixing, repetition, simhash, suffixdedup
from mutualis.session import Scratch, current_scope, materialize, scratch_scope, table_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay at their first place only."""
    return suffixdedup.drop_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to twice, by temperature."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with digests of the ids and of the decoded text."""
    return bpe.encode_documents(docs, keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mix", source_mix),
    ("bpe_encode", encode),
]

#: The stages' methods cannot be stated in SQL; the tests hold the result to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    outer, last = current_scope(), None
    for name, stage in STAGES:
        own = Scratch()  # the stage's result, kept until the next one has read it
        with scratch_scope(spark):
            docs = materialize(stage(spark, docs, sf_dir), name, scope=own)
        if last is not None:
            last.release(spark)
        last = own
    outer.folders += last.folders
    return docs
