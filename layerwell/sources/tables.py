"""Reading stored tables: whole, by partition, by window, as a snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, time, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerwell.errors import DataQualityError, MissingInputError
from layerwell.operators.selection import within
from layerwell.sources.table_log import TableState, table_state

# How partition folders spell special characters and nulls.
ESCAPED_IN_FOLDERS = set(map(chr, range(1, 32))) | set("\"#%'*/:=?\\\x7f{[]^")
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """A table, optionally only some columns and rows. Its log tells the columns
    that any of its files have; in a folder without a log, all files are opened
    to find out."""
    state = table_state(spark, path)
    try:
        if state is None:
            df = spark.read.option("mergeSchema", True).parquet(path)
        else:
            df = stored_rows(spark, path, state)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise MissingInputError(f"no table at {path}") from problem
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def stored_rows(spark: SparkSession, path: str, state: TableState) -> DataFrame:
    """The rows of a table in the given state of it."""
    return spark.read.schema(state.schema).parquet(*state.locations(path))


def read_partitions(
    spark: SparkSession, path: str, key: str, values: Sequence[str]
) -> DataFrame:
    """Rows of the given partitions. Their folders are named outright, so that a
    table of very many partitions need not be listed to find a few of them."""
    state = table_state(spark, path)
    place = state.location(path) if state else path
    folders = [f"{place}/{partition_folder(key, value)}" for value in values]
    reader = spark.read.schema(state.schema) if state else spark.read.option("mergeSchema", True)
    try:
        return reader.option("basePath", place).parquet(*folders)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        # Some have no rows and therefore no folder.
        return read_table(spark, path, where=F.col(key).isin(list(values)))


def partition_folder(key: str, value: object) -> str:
    """Name of a partition folder as Spark writes it."""
    text = str(value)
    escaped = "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_FOLDERS else c for c in text)
    return f"{key}={escaped or NULL_FOLDER}"


def read_partition(
    spark: SparkSession, path: str, schema: T.StructType, partition: Mapping[str, object]
) -> tuple[DataFrame, DataFrame]:
    """Rows of one partition and the files they are in. A partition that does
    not exist gives an empty frame with the table's columns, and no files."""
    state = table_state(spark, path)
    try:
        rows = spark.read.schema(schema).parquet(state.location(path) if state else path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema), spark.createDataFrame([], "path string")
    for key, value in partition.items():
        rows = rows.where(F.col(key).eqNullSafe(F.lit(value)))
    return rows, rows.select(F.col("_metadata.file_path").alias("path")).distinct()


def read_window(
    spark: SparkSession, path: str, partition_key: str, first: date, last: date
) -> DataFrame:
    """Partitions from ``first`` to ``last``, both included; others are not opened."""
    df = read_table(spark, path)
    low, high = day_bounds(df.schema[partition_key].dataType, first, last)
    return within(df, partition_key, low, high)


def read_snapshot(
    spark: SparkSession,
    path: str,
    snapshot_id: str,
    record_timestamp: str,
    first: date,
    last: date,
) -> DataFrame:
    """The one snapshot at ``path``, limited to the window. More than one
    snapshot is an error; rows without a timestamp are left out."""
    df = read_table(spark, path)
    found = df.select(snapshot_id).distinct().limit(2).count()
    if found != 1:
        raise DataQualityError(f"expected one snapshot at {path}, found {found or 'none'}")
    low, high = day_bounds(df.schema[record_timestamp].dataType, first, last)
    return within(df, record_timestamp, low, high)


def day_bounds(dtype: T.DataType, first: date, last: date):
    """Bounds of a window in the type of the column they filter.

    A plain date stands for the midnight that opens it, as daily records are
    stamped; an instant (such as "now") bounds timestamps exactly.
    """
    if isinstance(dtype, T.DateType):
        return tuple(b.date() if isinstance(b, datetime) else b for b in (first, last))
    zone = None if isinstance(dtype, T.TimestampNTZType) else timezone.utc
    return tuple(
        b if isinstance(b, datetime) else datetime.combine(b, time(), zone) for b in (first, last)
    )
