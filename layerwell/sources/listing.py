"""Which files exist, which are expected, which are new."""

from __future__ import annotations

import string
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerwell.errors import ConfigError
from layerwell.functions.dates import day_calendar
from layerwell.operators.selection import anti, first_by

LISTING_SCHEMA = "path string, file_name string, source_key string, modified_at timestamp, length bigint"

# Date codes of file-name templates and their Spark patterns.
DATE_CODES = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%B": "MMMM",
    "%b": "MMM",
    "%d": "dd",
    "%j": "DDD",
}


def source_key(file_name: Column) -> Column:
    """File name up to its first dot: ``20260101.export.CSV.zip`` is ``20260101``."""
    return F.regexp_extract(file_name, r"^(\.?[^.]*)", 1)


def own_file_name() -> Column:
    """Name of the file a row was read from."""
    return _decoded("_metadata.file_name")


def own_file_path() -> Column:
    """Full path of the file a row was read from, spelled as listings spell it."""
    return _decoded("_metadata.file_path")


def _decoded(column: str) -> Column:
    """Spark reports names percent-encoded; a plus sign stands for itself."""
    return F.url_decode(F.regexp_replace(F.col(column), r"\+", "%2B"))


def list_files(
    spark: SparkSession,
    folder: str,
    pattern: str | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """Files below ``folder`` without opening them; empty if it is missing.

    ``modified_after`` keeps the listing of a folder with a long history small.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    try:
        found = reader.load(folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    name = F.substring_index("path", "/", -1)
    return found.select(
        "path",
        name.alias("file_name"),
        source_key(name).alias("source_key"),
        F.col("modificationTime").alias("modified_at"),
        "length",
    )


def new_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose full path is not recorded in the manifest."""
    return anti(listing, manifest, "path")


def newest_file(listing: DataFrame) -> DataFrame:
    """The most recently modified file; equal times are settled by path."""
    return first_by(listing, F.col("modified_at").desc(), F.col("path").desc())


def key_collisions(listing: DataFrame) -> DataFrame:
    """Keys shared by several files, which would overwrite each other."""
    return (
        listing.groupBy("source_key")
        .agg(F.count_distinct("path").alias("files"), F.min("path").alias("first_path"))
        .where(F.col("files") > 1)
    )


def expected_files(
    spark: SparkSession,
    first: date,
    last: date,
    template: str,
    base_url: str | None = None,
    date_formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per day of the window: ``day``, ``file_name`` and ``url``."""
    days = spark.range(1).select(
        F.explode(day_calendar(_plain_date(first), _plain_date(last))).alias("day")
    )
    name = templated_name(F.col("day"), template, date_formats)
    url = F.concat(F.lit(f"{base_url}/"), name) if base_url else F.lit(None).cast("string")
    return days.select("day", name.alias("file_name"), url.alias("url"))


def files_to_acquire(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files whose key is not present yet. Order by ``day`` descending
    to fetch the newest first."""
    keyed = expected.withColumn("source_key", source_key(F.col("file_name")))
    return anti(keyed, present, "source_key").drop("source_key")


def templated_name(
    day: Column, template: str, date_formats: Mapping[str, str] | None = None
) -> Column:
    """Fill ``{year}``, ``{month:02d}``, ``{day:02d}`` and named date formats."""
    numbers = {"year": F.year(day), "month": F.month(day), "day": F.day(day)}
    formats = dict(date_formats or {})
    pieces: list[Column] = []
    for literal, name, width, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is None:
            continue
        if name in numbers:
            pieces.append(F.format_string(f"%{width or 'd'}", numbers[name]))
        elif formats.get(name) in DATE_CODES:
            pieces.append(F.date_format(day, DATE_CODES[formats[name]]))
        else:
            raise ConfigError(f"unknown field {name!r} in file name template {template!r}")
    return F.concat(*pieces)


def _plain_date(value: date | datetime) -> date:
    if not isinstance(value, datetime):
        return value
    if value.tzinfo is None:
        raise ValueError("a datetime bound must carry a time zone")
    return value.date()
