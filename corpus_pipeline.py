"""A training corpus from ``documents``: STAGES in order, each working on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns
of ``documents``; the last one returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagewise.llm import jaccard, language, line_dedup, packing, quality
from stagewise.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Its Python workers live on in later runs beside full heaps: they remember fewer words, and none after a task.
    return packing.packed_pieces(packing.pieces(docs, remembered=100_000, texts_at_once=3_000, forget=True))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

#: SQL can't express the MinHash stages and the tokenizer; tests/llm compares their operators with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; every stage's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
