"""Keep the latest record per key."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from layerwell.functions.casting import lenient_timestamp

log = logging.getLogger(__name__)

_RANK = "__rank"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    version: str | None,
    scope: Sequence[str] = (),
    tie_breakers: Sequence[Column] = (),
    ties_settled: bool = False,
) -> DataFrame:
    """One row per key: the one with the greatest version.

    * Rows with a null key are dropped; ``scope`` columns widen the key (per
      file, per partition) but may be null.
    * Ties are settled by ``tie_breakers`` and then by all remaining columns,
      so the outcome does not depend on how Spark split the input. With
      ``ties_settled`` the given ones suffice, and columns nobody needs stay
      unread.
    * Rows whose version is null or unreadable rank last.
    * Without a version column nothing is removed.

    The filter on the rank lets Spark keep only the first row per key in every
    map task before the exchange, so a key owning a large share of the rows
    sends one row per task and never gathers in one place.
    """
    if not version or version not in df.columns:
        log.warning("no version column %r; keeping every row", version)
        return df

    ordering = [version_order(df, version), *tie_breakers]
    if not ties_settled:
        ordering += stable_order(df, [*scope, *keys])
    # Keys first: rows are sorted by the first column's prefix, which a scope of few values leaves to full comparisons.
    window = Window.partitionBy(*_cols([*keys, *scope])).orderBy(*ordering)
    return (
        drop_null_keys(df, keys)
        .withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(_keyed(df, keys))


def _keyed(df: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key, column in zip(keys, _cols(keys)):
        condition = condition & column.isNotNull()
        if isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType)):
            condition = condition & ~F.isnan(column)
    return condition


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> Column:
    """Aggregate: how many rows of ``df`` :func:`keep_latest` would drop for keys
    that are null or not a number."""
    return F.count_if(~_keyed(df, keys))


def version_order(df: DataFrame, version: str) -> Column:
    """Newest first, unreadable last; text versions are compared as timestamps."""
    column, dtype = F.col(f"`{version}`"), df.schema[version].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        column = lenient_timestamp(column, dtype)
    return column.desc_nulls_last()


def stable_order(df: DataFrame, leave_out: Sequence[str]) -> list[Column]:
    """Ascending order over every other column that has an order."""
    return [
        F.col(f"`{f.name}`").asc_nulls_first()
        for f in df.schema.fields
        if f.name not in leave_out and not _unordered(f.dataType)
    ]


def _unordered(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _unordered(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_unordered(f.dataType) for f in dtype.fields)
    return False


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]
