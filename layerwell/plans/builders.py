"""Ready-made silver transforms and gold builders.

Each factory takes the names of the tables and columns it works on, so one
implementation serves every feed of that shape.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from layerwell.functions.casting import lenient_timestamp
from layerwell.functions.dates import month_floor, month_start_from_name, parse_compact_date
from layerwell.operators.joins import outer_by_key
from layerwell.operators.rollups import event_metrics, rollup, total
from layerwell.plans.registry import SilverTransform, required_input


@dataclass(frozen=True)
class Period:
    """Every row of the result stems from the rows of one day or one month of
    ``date_column`` in ``table``; ``result`` names that day or month."""

    table: str
    date_column: str
    result: str
    unit: str


@dataclass(frozen=True)
class Builder:
    """A gold builder whose result its settings and inputs determine. ``unique``
    is a key that the result holds once by construction."""

    kind: str
    settings: tuple
    build: Callable[[Mapping[str, DataFrame]], DataFrame] = field(repr=False, compare=False)
    unique: tuple[str, ...] = ()
    period: Period | None = None

    def __call__(self, inputs: Mapping[str, DataFrame]) -> DataFrame:
        return self.build(inputs)


def compact_dates(column: str) -> SilverTransform:
    """Turn ``yyyymmdd`` into timestamps; a table without the column is unchanged."""

    def transform(df: DataFrame) -> DataFrame:
        if column not in df.columns:
            return df
        return df.withColumn(column, parse_compact_date(F.col(column)))

    return transform


def month_names(month: str, year: str, result: str) -> SilverTransform:
    """Add the first day of the named month; unchanged without both columns."""

    def transform(df: DataFrame) -> DataFrame:
        if month not in df.columns or year not in df.columns:
            return df
        return df.withColumn(result, month_start_from_name(F.col(month), F.col(year)))

    return transform


def daily_event_metrics(
    table: str,
    key: str,
    means: Mapping[str, str],
    sums: Mapping[str, str],
    date_column: str,
    ids_are_unique: bool = False,
) -> Builder:
    """Event metrics per day. Set ``ids_are_unique`` for tables merged per day."""

    def build(inputs: Mapping[str, DataFrame]) -> DataFrame:
        df = required_input(inputs, table)
        metrics = event_metrics(key, means, sums, ids_are_unique=ids_are_unique)
        return rollup(df, lenient_period(df, date_column), date_column, metrics)

    settings = (table, key, tuple(means.items()), tuple(sums.items()), date_column, ids_are_unique)
    period = Period(table, date_column, date_column, "day")
    return Builder("daily event metrics", settings, build, (date_column,), period)


def monthly_event_metrics(
    table: str,
    key: str,
    means: Mapping[str, str],
    sums: Mapping[str, str],
    date_column: str,
    result: str,
) -> Builder:
    """Event metrics per month; dates must already be dates or timestamps."""

    def build(inputs: Mapping[str, DataFrame]) -> DataFrame:
        df = required_input(inputs, table)
        column = F.col(date_column)
        if isinstance(df.schema[date_column].dataType, T.StringType):
            column = F.to_timestamp(column)
        return rollup(df, month_floor(column), result, event_metrics(key, means, sums))

    settings = (table, key, tuple(means.items()), tuple(sums.items()), date_column, result)
    period = Period(table, date_column, result, "month")
    return Builder("monthly event metrics", settings, build, (result,), period)


def monthly_totals(table: str, value: str, date_column: str, result: str) -> Builder:
    """Sum of a count column per month."""

    def build(inputs: Mapping[str, DataFrame]) -> DataFrame:
        df = required_input(inputs, table)
        return rollup(df, F.col(date_column), date_column, [total(value).alias(result)])

    return Builder("monthly totals", (table, value, date_column, result), build, (date_column,))


def combined_monthly(
    left: str,
    right: str,
    left_columns: Mapping[str, str],
    right_columns: Mapping[str, str],
    key: str,
) -> Builder:
    """Two monthly tables side by side; months of either side are kept. Text
    keys must be readable as timestamps, otherwise the job fails."""

    def build(inputs: Mapping[str, DataFrame]) -> DataFrame:
        a, b = required_input(inputs, left), required_input(inputs, right)
        return outer_by_key(
            _strict_key(a, key), _strict_key(b, key), key, left_columns, right_columns
        )

    settings = (left, right, tuple(left_columns.items()), tuple(right_columns.items()), key)
    return Builder("combined monthly", settings, build)


def lenient_period(df: DataFrame, column: str):
    """A date or timestamp as it is, anything else parsed with nulls for bad values."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(column)
    return lenient_timestamp(F.col(column), dtype)


def _strict_key(df: DataFrame, key: str) -> DataFrame:
    if isinstance(df.schema[key].dataType, T.StringType):
        return df.withColumn(key, F.to_timestamp(key))
    return df
