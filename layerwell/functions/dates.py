"""Date parsing and truncation; unparsable values become null."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# Input formats.
COMPACT_DATE = "yyyyMMdd"
MONTH_NAME_DATE = "MMMM d yyyy"


def parse_compact_date(column: Column) -> Column:
    """``20240115`` (text or number) as a timestamp; exactly eight digits."""
    return F.try_to_timestamp(column.cast("string"), F.lit(COMPACT_DATE))


def month_start_from_name(month: Column, year: Column) -> Column:
    """First day of a month given its full English name and a year."""
    text = F.concat_ws(" ", month, F.lit("1"), year.cast("string"))
    return F.try_to_timestamp(text, F.lit(MONTH_NAME_DATE))


def month_floor(column: Column) -> Column:
    """Midnight of the first day of the month."""
    return F.date_trunc("month", column)


def day_calendar(first: date, last: date) -> Column:
    """Array of all days from ``first`` to ``last``, both included."""
    return F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))


def between_inclusive(column: Column, start, end) -> Column:
    """True inside the closed interval; null values are outside."""
    return column.isNotNull() & column.between(F.lit(start), F.lit(end))
