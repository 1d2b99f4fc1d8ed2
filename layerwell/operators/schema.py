"""Renaming and schema enforcement."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from layerwell.functions.casting import is_lost, lenient_cast, spark_type
from layerwell.spec import TableSpec

log = logging.getLogger(__name__)


def rename_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Give source columns their declared names; absent sources are ignored."""
    return df.withColumnsRenamed(spec.renames)


def enforce_schema(
    df: DataFrame,
    dtypes: Mapping[str, str],
    keep: Iterable[str] = (),
    on_error: str = "null_value",
    formats: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Exactly the declared columns, in declared order and type.

    Undeclared columns are dropped unless listed in ``keep``; missing ones are
    added as nulls. A value that cannot be cast becomes null; see
    :func:`lost_cells`. ``formats`` lists date patterns per column, of which the
    first that fits a text counts, before ISO. With
    ``on_error='null_column'`` a column other than a timestamp becomes null as
    a whole when any of its values cannot be cast, which costs one aggregation.
    """
    if on_error not in ("null_value", "null_column"):
        raise ValueError(f"unknown on_error: {on_error}")
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [name for name in dtypes if name not in present]
    if missing:
        log.warning("columns added as nulls: %s", missing)

    formats = formats or {}
    casts = {
        name: lenient_cast(F.col(f"`{name}`"), present[name], spark_type(dtype), formats.get(name, ()))
        for name, dtype in dtypes.items()
        if name in present
    }
    broken = _columns_with_bad_values(df, casts, dtypes) if on_error == "null_column" else ()

    declared = [
        casts[name].alias(name)
        if name in casts and name not in broken
        else F.lit(None).cast(spark_type(dtype)).alias(name)
        for name, dtype in dtypes.items()
    ]
    kept = [F.col(f"`{name}`") for name in keep if name in present and name not in dtypes]
    return df.select(*declared, *kept)


def lost_cells(
    df: DataFrame, dtypes: Mapping[str, str], formats: Mapping[str, Sequence[str]] | None = None
) -> dict[str, Column]:
    """Per declared column of another type than the stored one: a condition on
    the cells that :func:`enforce_schema` turns into null though they hold something."""
    formats = formats or {}
    return {
        field.name: is_lost(
            F.col(f"`{field.name}`"), field.dataType, spark_type(dtypes[field.name]), formats.get(field.name, ())
        )
        for field in df.schema.fields
        if field.name in dtypes and field.dataType != spark_type(dtypes[field.name])
    }


def rejected_values(
    df: DataFrame, dtypes: Mapping[str, str], formats: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """The values that are lost to the declared types: ``column``, ``value`` as
    text and ``rows``, how often it occurs. One pass, counted before the exchange."""
    cells = [
        F.when(lost, F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").cast("string").alias("value")))
        for name, lost in lost_cells(df, dtypes, formats).items()
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, value string, rows bigint")
    lost = df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    return lost.groupBy("cell.column", "cell.value").agg(F.count(F.lit(1)).alias("rows"))


def _columns_with_bad_values(df: DataFrame, casts, dtypes) -> set[str]:
    """Columns holding a value that its cast turns into null (one small row)."""
    per_value = [n for n in casts if "datetime" in dtypes[n].lower()]
    tests = [
        F.coalesce(F.bool_or(F.col(f"`{n}`").isNotNull() & cast.isNull()), F.lit(False)).alias(n)
        for n, cast in casts.items()
        if n not in per_value
    ]
    if not tests:
        return set()
    return {name for name, bad in df.agg(*tests).first().asDict().items() if bad}
