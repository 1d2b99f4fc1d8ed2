"""Data-quality checks with queryable results.

A check is an aggregate that counts failing rows. All checks of a table are
evaluated in one aggregation without an exchange of rows, or ride along with a
write as an observation. Only key uniqueness and completeness, which compare
rows with each other, run as aggregations of their own.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from layerwell.errors import DataQualityError
from layerwell.functions.casting import spark_type
from layerwell.functions.dates import day_calendar
from layerwell.operators.selection import anti, semi
from layerwell.spec import TableSpec

log = logging.getLogger(__name__)

CRITICAL = "critical"
WARNING = "warning"

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("failing", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("detail", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Check:
    """``failing`` counts failing rows; ``detail`` is an optional text aggregate.
    ``names`` lists the offenders of a check on the schema alone."""

    name: str
    column: str
    severity: str
    failing: Column
    detail: Column | None = None
    names: tuple[str, ...] | None = None


@dataclass(frozen=True)
class CheckResult:
    check: str
    column: str
    severity: str
    failing: int
    total: int
    passed: bool
    detail: str | None = None


# ---------------------------------------------------------------- row checks


def not_null(column: str, dtype: T.DataType | None = None) -> Check:
    """Nulls in a column that must not have any; NaN counts as null."""
    c = _col(column)
    missing = c.isNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(c)
    return Check("not_null", column, CRITICAL, F.count_if(missing))


def record_timestamp(df: DataFrame, column: str | None) -> Check:
    """The record timestamp must exist and should not be null."""
    if not column or column not in df.columns:
        return Check(
            "record_timestamp", column or "", WARNING, F.lit(1), F.lit("column missing")
        )
    return Check("record_timestamp", column, WARNING, F.count_if(_col(column).isNull()))


def value_range(column: str, minimum=None, maximum=None) -> Check:
    """Values outside the closed interval; nulls and NaN pass."""
    c = _col(column)
    outside = F.lit(False)
    if minimum is not None:
        outside = outside | (c < F.lit(minimum))
    if maximum is not None:
        outside = outside | ((c > F.lit(maximum)) & ~_is_nan(c))
    return Check("value_range", column, WARNING, F.count_if(outside))


def valid_categories(column: str, allowed: Sequence) -> Check:
    """Values that are not in the list; null is not in the list."""
    valid = F.coalesce(_col(column).isin(list(allowed)), F.lit(False))
    return Check("valid_categories", column, WARNING, F.count_if(~valid))


def string_format(column: str, pattern: str) -> Check:
    """Text that does not start with the pattern; null does not match."""
    matches = F.coalesce(_col(column).rlike(f"^(?:{pattern})"), F.lit(False))
    return Check("string_format", column, WARNING, F.count_if(~matches))


def not_negative(column: str) -> Check:
    return Check("not_negative", column, WARNING, F.count_if(_col(column) < 0))


def no_future_dates(column: str, now: datetime) -> Check:
    return Check("no_future_dates", column, WARNING, F.count_if(_col(column) > F.lit(now)))


def data_recency(column: str, now: datetime, allowed: timedelta) -> Check:
    """Fails when the newest value is older than allowed; no rows pass."""
    latest = F.max(column)
    stale = F.coalesce((latest < F.lit(now - allowed)).cast("bigint"), F.lit(0))
    return Check("data_recency", column, WARNING, stale, latest.cast("string"))


# ------------------------------------------------------------- schema checks


def required_columns(df: DataFrame, wanted: Iterable[str]) -> Check:
    return _names_check("required_columns", CRITICAL, _absent(df, wanted))


def primary_keys_exist(df: DataFrame, keys: Iterable[str]) -> Check:
    return _names_check("primary_keys_exist", CRITICAL, _absent(df, keys))


def partition_keys_exist(df: DataFrame, keys: Iterable[str]) -> Check:
    return _names_check("partition_keys_exist", CRITICAL, _absent(df, keys))


def extra_columns(df: DataFrame, declared: Iterable[str]) -> Check:
    known = set(declared)
    return _names_check("extra_columns", WARNING, [c for c in df.columns if c not in known])


def column_types(df: DataFrame, dtypes: Mapping[str, str]) -> Check:
    """Columns whose type family differs; declared text is not compared."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{name}: expected {dtype}, got {actual[name].simpleString()}"
        for name, dtype in dtypes.items()
        if name in actual and _family(spark_type(dtype)) not in (None, _family(actual[name]))
    ]
    return _names_check("column_types", WARNING, wrong)


def _family(dtype: T.DataType) -> str | None:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "float"
    return None if isinstance(dtype, T.StringType) else dtype.simpleString()


def _absent(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in wanted if name not in present]


def _names_check(name: str, severity: str, names: Sequence[str]) -> Check:
    return Check(
        name, "", severity, F.lit(len(names)), F.lit("; ".join(names)), names=tuple(names)
    )


# ------------------------------------------------------------- running checks


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Tidy result table, one row per check, from one pass over ``df``."""
    summary = df.agg(*_metrics(checks))
    rows = [
        F.struct(
            F.lit(check.name).alias("check"),
            F.lit(check.column).alias("column"),
            F.lit(check.severity).alias("severity"),
            F.col(f"failing_{i}").alias("failing"),
            F.col("total"),
            (F.col(f"failing_{i}") == 0).alias("passed"),
            F.col(f"detail_{i}").alias("detail"),
        )
        for i, check in enumerate(checks)
    ]
    return summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def observe_checks(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """Attach the checks to ``df``: whatever action runs it also fills them in."""
    observation = Observation()
    return df.observe(observation, *_metrics(checks)), observation


def observed_results(checks: Sequence[Check], observation: Observation) -> list[CheckResult]:
    """Results of :func:`observe_checks`, once the action has finished."""
    metrics = observation.get
    return [
        CheckResult(
            check.name,
            check.column,
            check.severity,
            metrics[f"failing_{i}"],
            metrics["total"],
            metrics[f"failing_{i}"] == 0,
            metrics[f"detail_{i}"],
        )
        for i, check in enumerate(checks)
    ]


def _metrics(checks: Sequence[Check]) -> list[Column]:
    metrics = [F.count(F.lit(1)).alias("total")]
    for i, check in enumerate(checks):
        detail = F.lit(None) if check.detail is None else check.detail
        metrics.append(check.failing.cast("bigint").alias(f"failing_{i}"))
        metrics.append(detail.cast("string").alias(f"detail_{i}"))
    return metrics


def collect_results(results: DataFrame) -> list[CheckResult]:
    """Result rows as objects; there are as many as there are checks."""
    return [CheckResult(**row.asDict()) for row in results.collect()]


def results_table(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    return spark.createDataFrame([vars(r) for r in results], RESULT_SCHEMA)


def enforce(results: Iterable[CheckResult]) -> list[CheckResult]:
    """Raise for failed critical checks, log the failed others."""
    results = list(results)
    failed = [r for r in results if not r.passed]
    for r in failed:
        if r.severity != CRITICAL:
            log.warning("%s %s: %s of %s rows (%s)", r.check, r.column, r.failing, r.total, r.detail)
    critical = [r for r in failed if r.severity == CRITICAL]
    if critical:
        raise DataQualityError(
            "; ".join(f"{r.check} {r.column} {r.detail or r.failing}".strip() for r in critical)
        )
    return results


def enforce_schema_checks(*checks: Check) -> None:
    """Judge checks on the schema alone, before any data is read."""
    enforce(
        CheckResult(
            c.name, c.column, c.severity, len(c.names), 0, not c.names, "; ".join(c.names)
        )
        for c in checks
        if c.names is not None
    )


# --------------------------------------------------------------- key uniqueness


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their row count; nulls are equal.

    Counts are combined before the exchange, so a hot key costs one row per task.
    """
    counted = df.groupBy(*(_col(k) for k in keys)).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("rows") > 1)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of keys that occur more than once."""
    return semi(df, duplicate_keys(df, keys), keys)


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Result row for duplicate primary keys; every row of a group counts."""
    counted = df.groupBy(*(_col(k) for k in keys)).agg(F.count(F.lit(1)).alias("rows"))
    repeated = F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0))
    return counted.agg(
        F.lit("primary_key_uniqueness").alias("check"),
        F.lit(",".join(keys)).alias("column"),
        F.lit(CRITICAL).alias("severity"),
        repeated.alias("failing"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        (repeated == 0).alias("passed"),
        F.lit(None).cast("string").alias("detail"),
    )


# ----------------------------------------------------------------- completeness


def gaps_per_entity(
    df: DataFrame, entity: Sequence[str], column: str, first: date, last: date
) -> DataFrame:
    """Runs of days from ``first`` to ``last`` on which an entity has no row: the
    entity, gap_first, gap_last and days. Entities without a single row in the
    window are one gap; rows without a date tell only that the entity exists.

    One row per entity and day is compared with the next one, so that nothing is
    spread out over the calendar, however long it is.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    day = F.to_date(column)
    inside = F.when(day.between(low, high), day)
    seen = df.select(*entity, inside.alias("__day")).distinct()
    # A day before the window opens it for every entity, whatever rows it has.
    opened = seen.select(*entity, F.explode(F.array("__day", F.date_sub(low, 1))).alias("__day"))
    days = opened.where(F.col("__day").isNotNull()).distinct()
    following = F.lead("__day").over(Window.partitionBy(*entity).orderBy("__day"))
    return (
        days.withColumn("__next", F.coalesce(following, F.date_add(high, 1)))
        .where(F.datediff("__next", "__day") > 1)
        .select(
            *entity,
            F.date_add("__day", 1).alias("gap_first"),
            F.date_sub("__next", 1).alias("gap_last"),
            (F.datediff("__next", "__day") - 1).cast("bigint").alias("days"),
        )
    )


def missing_days(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Calendar days without any row, both ends included."""
    days = df.sparkSession.range(1).select(F.explode(day_calendar(first, last)).alias("day"))
    present = df.select(_col(column).cast("date").alias("day"))
    return anti(days, present, "day")


def missing_members(df: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys (entities, partitions) that have no row."""
    return anti(expected.select(*keys).distinct(), df, keys)


def completeness(
    missing: DataFrame, name: str, column: str, severity: str = WARNING, expected: int | None = None
) -> DataFrame:
    """Result row for a table of missing days or members, of ``expected`` ones."""
    gaps = F.count(F.lit(1))
    return missing.agg(
        F.lit(name).alias("check"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        gaps.alias("failing"),
        F.lit(expected).cast("bigint").alias("total"),
        (gaps == 0).alias("passed"),
        F.lit(None).cast("string").alias("detail"),
    )


# ------------------------------------------------------------- suites per layer


def table_checks(df: DataFrame, spec: TableSpec) -> list[Check]:
    """Checks every silver and gold table goes through, fit for one pass."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    return [
        required_columns(df, spec.column_names),
        primary_keys_exist(df, spec.primary_keys),
        *(not_null(c, dtypes[c]) for c in spec.non_nullable if c in dtypes),
        column_types(df, spec.dtypes),
    ]


def union_results(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _is_nan(column: Column) -> Column:
    return F.coalesce(F.isnan(column.try_cast("double")), F.lit(False))
