"""Quality classifier by importance resampling.

Two bags of hashed word unigrams and bigrams are counted over the corpus: all
documents, and documents labelled good. A document's weight is the log ratio of
the two generative models over its features, and adding Gumbel noise before
taking the top k samples documents without replacement in proportion to their
weights. Counts are summed per task before they are shuffled; what reaches the
driver is one number per bucket, however large the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import batch_of, columns, gram_hashes, in_batches, running_total, word_hashes
from layerwell.sinks.parquet import stage

BUCKETS = 10_000
TARGET_ROWS = 20_000  # labelled documents that the target model is fitted on, at most
SMOOTHING = 1.0
SHARE = 0.85  # of the documents that are sampled
SEED = 8
RANK_RANGES = 256


def features(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a text's words and pairs of neighbouring words."""
    hashes = word_hashes((text or "").lower().encode().split())
    pairs = gram_hashes(hashes, 2)
    return np.concatenate([hashes % np.uint64(buckets), pairs % np.uint64(buckets)]).astype(np.int64)


def target_ids(labels: DataFrame, most: int = TARGET_ROWS) -> DataFrame:
    """Ids labelled good: all, or ``most`` of them chosen by a hash."""
    good = columns(labels, "doc_id", "quality").where("quality = 1 and doc_id is not null")
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability, per bucket."""
    good = target_ids(labels).withColumn("_good", F.lit(True))
    flagged = columns(docs, "doc_id", "text").join(F.broadcast(good), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, is_good in zip(batch.column("text").to_pylist(), batch.column("_good").to_pylist()):
                counts = np.bincount(features(text, buckets), minlength=buckets)
                raw += counts
                if is_good:
                    target += counts
        seen = np.flatnonzero(raw)
        yield batch_of(["bucket", "raw", "target"], [seen, raw[seen], target[seen]], [pa.int64()] * 3)

    counted = in_batches(flagged.select("text", "_good"), count, "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, r, t in rows:
        raw[bucket], target[bucket] = r, t
    if not target.any():
        return np.zeros(buckets)
    smooth = [(x + SMOOTHING) / (x.sum() + SMOOTHING * buckets) for x in (target, raw)]
    return np.log(smooth[0]) - np.log(smooth[1])


def weigh_documents(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_features, log_weight, sample_key (with the noise)."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            sizes, weights = [], []
            for text in batch.column("text").to_pylist():
                own = features(text, len(table))
                sizes.append(len(own))
                weights.append(float(table[own].sum()))
            yield batch_of(
                ["doc_id", "noise", "n_features", "log_weight"],
                [batch.column("doc_id"), batch.column("noise"), sizes, weights],
                [None, None, pa.int64(), pa.float64()],
            )

    rows = columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.crc32(F.col("text").cast("binary"))).alias("noise"),
    )
    scored = in_batches(rows, run, "doc_id long, noise long, n_features long, log_weight double")
    # 52 bits of the hash, moved off the ends of (0, 1).
    uniform = (F.shiftrightunsigned("noise", 12).cast("double") + 0.5) / float(2**52)
    return scored.withColumn("sample_key", F.col("log_weight") - F.log(-F.log(uniform)))


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """Every row with n_features, log_weight, sample_key and selected: whether
    it is one of the floor(share * rows) rows with the largest keys.

    Null and empty texts have no features and the weight 0. Without labelled
    documents all weights are 0 and the sample is a plain one. Rows equal in
    doc_id and text have equal keys; which of them is taken at the limit is left
    open. An empty table gives no rows; other columns are ignored.
    """
    weighed = stage(weigh_documents(docs, labels, seed))
    cuts = weighed.approxQuantile("sample_key", [i / RANK_RANGES for i in range(1, RANK_RANGES)], 0.001)
    cuts = F.array(*map(F.lit, sorted(set(cuts)))) if cuts else F.array(F.lit(0.0))
    larger = F.size(F.filter(cuts, lambda cut: cut > F.col("sample_key")))
    ranked = running_total(
        weighed.withColumn("_range", larger), [], "_range",
        [F.desc("sample_key"), "doc_id", "noise"], F.lit(1).cast("long"), "_rank", total="_rows",
    )
    return ranked.select(
        "doc_id", "n_features", "log_weight", "sample_key",
        (F.col("_rank") < F.floor(F.col("_rows") * F.lit(share))).alias("selected"),
    )
