"""Joining finished tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def outer_by_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_columns: Mapping[str, str],
    right_columns: Mapping[str, str],
) -> DataFrame:
    """Full outer join on one key; a null key on one side meets a null key on
    the other. The mappings pick columns of each side and name them apart."""
    a = left.select(F.col(key).alias("__left"), *_renamed(left_columns))
    b = right.select(F.col(key).alias("__right"), *_renamed(right_columns))
    joined = a.join(b, F.col("__left").eqNullSafe(F.col("__right")), "full_outer")
    return joined.select(
        F.coalesce("__left", "__right").alias(key),
        *left_columns.values(),
        *right_columns.values(),
    )


def _renamed(columns: Mapping[str, str]):
    return [F.col(old).alias(new) for old, new in columns.items()]
