"""Choosing a reader by the declared file type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerwell.errors import ConfigError
from layerwell.operators.lineage import SOURCE_FILE, SOURCE_POSITION
from layerwell.sources.delimited import read_delimited, read_zipped_delimited
from layerwell.sources.listing import own_file_name
from layerwell.sources.workbook import read_workbooks
from layerwell.spec import SourceSpec


def read_files(spark: SparkSession, paths: Sequence[str], source: SourceSpec) -> DataFrame:
    """All files in one DataFrame: their columns, the file name and the
    position of the row in its file."""
    kind, zipped = source.file_type.lower(), source.compression == "zip"
    if kind == "csv":
        read = read_zipped_delimited if zipped else read_delimited
        return read(spark, paths, source.reader)
    if kind == "xlsx":
        return read_workbooks(spark, paths, source.reader, zipped)
    if kind == "parquet":
        return _read_parquet_files(spark, paths)
    raise ConfigError(f"source {source.name}: unsupported file type {source.file_type}")


def _read_parquet_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    rows = spark.read.option("mergeSchema", True).parquet(*paths)
    position = F.struct(
        F.lit(0).cast("bigint").alias("block"), F.col("_metadata.row_index").alias("row")
    )
    return rows.select(
        "*", own_file_name().alias(SOURCE_FILE), position.alias(SOURCE_POSITION)
    )
