"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The ASCII white space that separates words, \x20 and \x09-\x0D.
WHITE_SPACE = " \t\n\x0b\x0c\r"

# Ranges into which a sort order is cut for two-level running totals. One table
# row per range and group; the rows of one range are summed by one task.
RANGES = 4096

# Size of the Arrow batches that Python workers get, at most (or one row).
BATCH_BYTES = "8m"

# A null doc_id is ordered before all others.
NO_ID = -(2**63)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever others there are."""
    return df.select(*[F.col(f"`{name}`") for name in names])


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; a null is an empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def batch_of(names: Sequence[str], arrays: Sequence, types: Sequence[pa.DataType]) -> pa.RecordBatch:
    made = [a if isinstance(a, pa.Array) else pa.array(a, t) for a, t in zip(arrays, types)]
    return pa.RecordBatch.from_arrays(made, list(names))


def in_batches(df: DataFrame, run: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes, not by rows alone: a batch of
    long texts must fit into a Python worker several times over."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def mapped(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``step`` to every Arrow batch; ``None`` means no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := step(batch)) is not None:
                yield made

    return in_batches(df, run, schema)


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hash of every word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, from the hashes of the words."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[i : i + size]
        out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def document_key() -> list[Column]:
    """Two columns that tell documents apart: the id, and a hash of the text for
    ids that occur more than once. Rows equal in both are the same document."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(F.col("text")).alias("th"),
    ]


def hash_below(key: Column, distinct: int, wanted: int) -> Column:
    """A condition on a 64-bit hash that about ``wanted`` of ``distinct`` values
    meet, or all where there are no more: a sample without a sort of all rows."""
    share = min(1.0, wanted / max(1, distinct))
    return key <= F.lit(min(2**63 - 1, int(share * 2**64) - 2**63))


def running_total(
    df: DataFrame,
    by: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    amount: Column,
    name: str,
    total: str | None = None,
) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over all rows of the group ``by``
    before this one, in the order of (``bucket``, ``order``); and ``total``, if
    named: the sum over the whole group. The columns ``by`` must not be null.

    Two levels: sums per bucket, summed over the at most ``RANGES`` buckets of a
    group, plus a running sum within each bucket. So a group that holds a third
    of all rows is shared by as many tasks as it has buckets.
    """
    keys = [*by, bucket]
    totals = df.groupBy(*keys).agg(F.sum(amount).alias("_rt_sum"))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    up_to = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    before = totals.select(
        *keys,
        (F.sum("_rt_sum").over(up_to) - F.col("_rt_sum")).alias("_rt_before"),
        *([F.sum("_rt_sum").over(group).alias(total)] if total else []),
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_rt_within", F.sum(amount).over(within) - amount)
        .join(before, keys)
        .withColumn(name, F.col("_rt_within") + F.col("_rt_before"))
        .drop("_rt_within", "_rt_before")
    )
