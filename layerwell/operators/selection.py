"""Window filters and newest-snapshot selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from layerwell.functions.dates import between_inclusive


def within(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows inside the closed interval. On a partition column this prunes
    directories, on any other Parquet column row groups."""
    return df.where(between_inclusive(F.col(column), start, end))


def newest(df: DataFrame, marker: str) -> DataFrame:
    """Only the rows of the newest snapshot, judged by ``marker``.

    The maximum is one row, so broadcasting it is bounded whatever the table.
    """
    top = df.agg(F.max(marker).alias("__newest"))
    return df.join(F.broadcast(top), F.col(marker) == F.col("__newest"), "left_semi")


def first_by(df: DataFrame, *order) -> DataFrame:
    """The first row in the given order."""
    return df.orderBy(*order).limit(1)


def anti(df: DataFrame, known: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``known``."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def semi(df: DataFrame, wanted: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``wanted``; null keys meet null keys."""
    return _null_safe(df, wanted, on, "left_semi")


def unmatched(df: DataFrame, wanted: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` that :func:`semi` leaves out."""
    return _null_safe(df, wanted, on, "left_anti")


def _null_safe(df: DataFrame, wanted: DataFrame, on: str | Sequence[str], how: str) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    right = wanted.select(*(F.col(f"`{k}`").alias(f"__wanted_{k}") for k in keys))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"`{k}`").eqNullSafe(F.col(f"`__wanted_{k}`"))
    return df.join(right, condition, how)
