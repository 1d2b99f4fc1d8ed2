"""The registered queries of the operators, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerwell.llm import (
    decontamination,
    html_extraction,
    importance,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    quality_rules,
    sharding,
    spelling,
    substring_dedup,
    token_counts,
    whitening,
)
from layerwell.llm.common import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_after_clean_up(read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find_repeats(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(read(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_text(read(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(read(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(read(spark, sf_dir, "embeddings"))
    # Null where the exact sum is beyond a long, from some millions of distinct vectors on.
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_token_counts, op2_sharding, op3_substring_dedup, op4_quality_rules, op5_packing,
        op6_decontamination, op7_language_id, op8_quality_classifier, op9_simhash_dedup,
        op10_html_extraction, op11_spelling_variants, op12_line_dedup, op13_whitening,
    )
}

# The others need hashes, tokenizers, trained models or alignments that SQL lacks.
ORACLE = {
    "op2_sharding": sharding.ORACLE_SQL,
    "op4_quality_rules": quality_rules.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_line_dedup": line_dedup.ORACLE_SQL,
}
