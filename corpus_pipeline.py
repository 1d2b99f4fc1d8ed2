"""A training corpus from raw documents, in five stages.

Each stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerwell.llm import decontamination, near_dedup, packing, quality_rules, substring_dedup
from layerwell.llm.common import read
from layerwell.sinks.parquet import stage


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed; documents that the rules reject go."""
    return quality_rules.clean_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat an earlier document's are cut out."""
    return substring_dedup.cut_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into sequences of a controlled mixture."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", clean),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# Hashes, alignments and a tokenizer are beyond SQL; tests/llm compares with a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
