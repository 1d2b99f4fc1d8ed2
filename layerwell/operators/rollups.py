"""Daily and monthly metrics."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

log = logging.getLogger(__name__)


def total(column: str | Column) -> Column:
    """Sum in which a group of nulls counts as zero."""
    return F.coalesce(F.sum(column), F.lit(0))


def rollup(df: DataFrame, period: Column, name: str, metrics: Sequence[Column]) -> DataFrame:
    """Aggregate ``metrics`` per ``period``; rows without a period are left out."""
    return df.where(period.isNotNull()).groupBy(period.alias(name)).agg(*metrics)


def event_metrics(
    key: str,
    means: Mapping[str, str],
    sums: Mapping[str, str],
    count_as: str = "total_events",
    ids_are_unique: bool = False,
    approximate_error: float | None = None,
) -> list[Column]:
    """Distinct values of ``key``, then means and sums; both of these map a
    column to the name of its result.

    An exact distinct count needs an exchange on (period, id). It is spared
    when ``ids_are_unique`` within a period, as a table merged per day
    guarantees for daily periods: then only partial aggregates travel.
    ``approximate_error`` asks for a sketch instead, also without that exchange.
    """
    if ids_are_unique:
        events = F.count(key)
    elif approximate_error is not None:
        events = F.approx_count_distinct(key, approximate_error)
    else:
        events = F.count_distinct(F.col(key))
    return [
        events.alias(count_as),
        *(F.avg(column).alias(name) for column, name in means.items()),
        *(total(column).alias(name) for column, name in sums.items()),
    ]
