"""Declared type names and casts that yield null instead of failing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from layerwell.errors import ConfigError

# Type names accepted in table declarations.
INTEGER_NAMES = ("int64", "int32", "int", "long", "bigint", "integer")
FLOAT_NAMES = ("float64", "float32", "float", "double")
STRING_NAMES = ("string", "str", "object")
DATE_NAMES = ("date",)


def spark_type(name: str) -> T.DataType:
    """Spark type of a declared type name; names are case-insensitive and any
    name containing ``datetime`` or ``timestamp`` is a timestamp."""
    lowered = name.lower()
    if "datetime" in lowered or "timestamp" in lowered:
        return T.TimestampType()
    if lowered in INTEGER_NAMES:
        return T.LongType()
    if lowered in FLOAT_NAMES:
        return T.DoubleType()
    if lowered in STRING_NAMES:
        return T.StringType()
    if lowered in DATE_NAMES:
        return T.DateType()
    raise ConfigError(f"unknown column type: {name}")


def lenient_timestamp(
    column: Column, source: T.DataType, formats: Sequence[str] = ()
) -> Column:
    """Timestamp from text, a date, or nanoseconds since the epoch. Text is read
    by the first of ``formats`` (Spark's date patterns) that fits, else as ISO."""
    if formats and isinstance(source, T.StringType):
        known = [F.try_to_timestamp(column, F.lit(pattern)) for pattern in formats]
        return F.coalesce(*known, column.try_cast("timestamp"))
    if isinstance(source, T.NumericType):
        nanoseconds = column.try_cast("decimal(20,0)")
        return F.timestamp_micros(F.floor(nanoseconds / 1000).cast("bigint"))
    return column.try_cast("timestamp")


def lenient_cast(
    column: Column, source: T.DataType, target: T.DataType, formats: Sequence[str] = ()
) -> Column:
    """Per-value cast; values that do not fit become null.

    Fractions never turn into integers by truncation, and NaN counts as null.
    """
    fractional = isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType))
    if source == target:
        result = column
    elif isinstance(target, T.TimestampType):
        result = lenient_timestamp(column, source, formats)
    elif isinstance(target, T.DateType):
        result = lenient_timestamp(column, source, formats).cast("date")
    elif isinstance(target, T.LongType) and fractional:
        result = F.when(column == F.floor(column), column.try_cast(target))
    else:
        result = column.try_cast(target)
    return nan_to_null(result) if isinstance(target, T.DoubleType) else result


def is_lost(
    column: Column, source: T.DataType, target: T.DataType, formats: Sequence[str] = ()
) -> Column:
    """Whether a cell that holds something becomes null by the cast. NaN holds nothing."""
    lost = column.isNotNull() & lenient_cast(column, source, target, formats).isNull()
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return lost & ~F.isnan(column)
    if isinstance(target, T.DoubleType):
        return lost & column.try_cast(target).isNull()
    return lost


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)
