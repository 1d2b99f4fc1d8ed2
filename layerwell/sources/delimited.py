"""Delimited text. Every column is text; typing comes later."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerwell.errors import ConfigError
from layerwell.operators.lineage import SOURCE_FILE, SOURCE_POSITION
from layerwell.sources.archive import archive_lines
from layerwell.sources.listing import own_file_name, own_file_path

# Reader parameters understood in source declarations.
READER_PARAMETERS = (
    "sep",
    "header",
    "names",
    "skipinitialspace",
    "quotechar",
    "encoding",
    "null_values",
    "multi_line",
    "mode",
    "spread",
    "bad_lines",
    "one_header",
)

# The raw text of a line that has more fields than there are names.
BAD_LINE = "_bad_line"


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    reader: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Plain or gzip/bzip2 text files, split by Spark where the format allows.

    ``header: 0`` takes the names from the first row unless ``names`` are given;
    ``header: null`` requires ``names``. Files with the same header are read
    together, and files whose headers differ united by name, columns that a file
    lacks being null. The first lines cost one pass over the text, which a single
    file does not need; ``one_header: true`` spares it, and a file with another
    header than the first one then makes the job fail instead of shifting columns.

    A line with fewer fields is filled up with nulls. One with more, other than
    blank ones, is an error, or with ``bad_lines: keep`` a row of nulls whose
    column ``_bad_line`` holds the line.
    """
    reader = _checked(reader)
    names, has_header = reader.get("names"), reader.get("header") is not None
    if not names and not has_header:
        raise ConfigError("text files without a header need column names")

    if names or reader.get("one_header"):
        return _read_alike(spark, paths, reader)
    groups = _paths_by_header(spark, paths)
    if len(groups) < 2:
        return _read_alike(spark, paths, reader)
    return _united(_read_alike(spark, group, reader) for group in groups)


def _united(parts) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _paths_by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Files of the same first line, the group of the first path before others."""
    lines = spark.read.text(list(paths))
    if len(lines.inputFiles()) < 2:
        return []
    # A header is in the first block of its file; min_by keeps one line a file and task.
    first = (
        lines.where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        .select(own_file_path().alias("path"), "value", F.monotonically_increasing_id().alias("row"))
        .groupBy("path")
        .agg(F.min_by("value", "row").alias("header"))
    )
    return _groups(first)


def _groups(first: DataFrame) -> list[list[str]]:
    """Paths of each ``header``. The paths of a read are in the driver anyway."""
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return sorted(list(row["paths"]) for row in found)


def _read_alike(spark: SparkSession, paths: Sequence[str], reader: Mapping[str, Any]) -> DataFrame:
    """Files that share their names."""
    names, has_header = reader.get("names"), reader.get("header") is not None
    source = spark.read.options(**csv_options(reader)).option("header", has_header)
    if not names:
        names = source.csv(list(paths)).columns
        source = source.option("enforceSchema", False)
    rows = judged(source.schema(text_schema(names)).csv(list(paths)), names, reader)
    position = F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(
        *nulls_for_blanks(names, reader),
        *kept_lines(reader),
        own_file_name().alias(SOURCE_FILE),
        position.alias(SOURCE_POSITION),
    )


def read_zipped_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    reader: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Zip archives holding one text file each.

    One task unpacks an archive. Where single archives hold a large share of the
    data, ``spread: true`` lets other tasks share in parsing and writing them.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return parse_zipped_delimited(files, reader)


def parse_zipped_delimited(
    files: DataFrame, reader: Mapping[str, Any] | None = None
) -> DataFrame:
    """As :func:`read_zipped_delimited` for rows of ``path`` and ``content``. Archives
    are unpacked once for their headers and once for their rows.

    Python only unpacks lines; Spark parses them with the options it also uses
    for plain text.
    """
    reader = _checked(reader)
    names, has_header = reader.get("names"), reader.get("header") is not None
    lines = archive_lines(
        files,
        reader.get("encoding", "utf-8"),
        reader.get("quotechar", '"') if reader.get("multi_line") else None,
    )
    if not names:
        if not has_header:
            raise ConfigError("text files without a header need column names")
        groups = _groups(lines.where(F.col("line_no") == 0).select("path", F.col("line").alias("header")))
        if not groups:
            raise ConfigError("archives are empty")
        if len(groups) > 1 and reader.get("one_header"):
            raise ConfigError("the headers of archives differ")
        if len(groups) > 1:
            return _united(
                parse_zipped_delimited(files.where(F.col("path").isin(group)), {**reader, "one_header": True})
                for group in groups
            )
        names = _names_in_header(lines, reader)
    if has_header:
        lines = lines.where(F.col("line_no") > 0)
    if reader.get("spread"):
        lines = lines.hint("rebalance", "path")
    parsed = F.from_csv("line", text_schema(names).toDDL(), csv_options(reader))
    rows = lines.where(F.length("line") > 0).select(
        parsed.alias("fields"), "path", "line_no"
    )
    rows = judged(rows.select("fields.*", "path", "line_no"), names, reader)
    return rows.select(
        *nulls_for_blanks(names, reader),
        *kept_lines(reader),
        F.substring_index("path", "/", -1).alias(SOURCE_FILE),
        F.struct(F.lit(0).cast("bigint").alias("block"), F.col("line_no").alias("row")).alias(
            SOURCE_POSITION
        ),
    )


def text_schema(names: Sequence[str]) -> T.StructType:
    """Text columns, and the raw text of lines that do not have as many fields."""
    return T.StructType([T.StructField(name, T.StringType()) for name in (*names, BAD_LINE)])


def judged(rows: DataFrame, names: Sequence[str], reader: Mapping[str, Any]) -> DataFrame:
    """The rows, with ``_bad_line`` null but for lines that have more fields than
    names; these have no values. Unless they are to be kept, one stops the job."""
    line = F.col(BAD_LINE)
    # Always true. Lines are judged only where all columns are read, whatever is selected.
    parsed = F.length(F.concat_ws("", *(F.col(f"`{name}`") for name in names))) >= 0
    surplus = F.when(line.isNull(), False).otherwise(_has_surplus(line, len(names), reader) & parsed)
    if reader.get("bad_lines", "error") != "keep":
        message = F.concat(F.lit("a line has more fields than names: "), F.left(line, F.lit(200)))
        return rows.where(F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(True)).drop(BAD_LINE)
    return rows.withColumn(BAD_LINE, F.when(surplus, line)).withColumns(
        {name: F.when(F.col(BAD_LINE).isNull(), F.col(f"`{name}`")) for name in names}
    )


def _has_surplus(line: Column, names: int, reader: Mapping[str, Any]) -> Column:
    """Whether any field beyond the names is not blank. A field in quotes, which
    may hold separators, counts as one letter or, if there is nothing in it, none."""
    quote, sep = re.escape(reader.get("quotechar", '"')), re.escape(reader.get("sep", ","))
    plain = F.regexp_replace(line, f"(^|{sep}){quote}{quote}(?={sep}|$)", "$1")
    plain = F.regexp_replace(plain, f"(^|{sep}){quote}(?:[^{quote}]|{quote}{quote})+{quote}(?={sep}|$)", "$1x")
    fields = F.split(plain, sep, -1)
    beyond = F.slice(fields, names + 1, F.greatest(F.size(fields) - names, F.lit(0)))
    return F.exists(beyond, lambda field: F.trim(field) != "")


def kept_lines(reader: Mapping[str, Any]) -> list[Column]:
    return [F.col(BAD_LINE)] if reader.get("bad_lines") == "keep" else []


def csv_options(reader: Mapping[str, Any]) -> dict[str, str]:
    quote = reader.get("quotechar", '"')
    return {
        "sep": reader.get("sep", ","),
        "quote": quote,
        # A doubled quote stands for itself, as spreadsheets write it.
        "escape": quote,
        "encoding": reader.get("encoding", "utf-8"),
        "ignoreLeadingWhiteSpace": str(bool(reader.get("skipinitialspace", False))).lower(),
        "multiLine": str(bool(reader.get("multi_line", False))).lower(),
        "mode": reader.get("mode", "PERMISSIVE"),
        "columnNameOfCorruptRecord": BAD_LINE,
    }


def nulls_for_blanks(names: Sequence[str], reader: Mapping[str, Any]) -> list[Column]:
    """Empty text, quoted or not, and the configured markers become null."""
    markers = ["", *reader.get("null_values", ())]
    return [F.when(~F.col(f"`{n}`").isin(markers), F.col(f"`{n}`")).alias(n) for n in names]


def _names_in_header(lines: DataFrame, reader: Mapping[str, Any]) -> list[str]:
    """Names in the first row, on which the archives agree."""
    headers = lines.where(F.col("line_no") == 0).select("line").take(1)
    text = lines.sparkSession.createDataFrame(headers, "line string")
    slots = [f"c{i}" for i in range(headers[0]["line"].count(reader.get("sep", ",")) + 1)]
    parsed = F.from_csv("line", text_schema(slots).toDDL(), csv_options(reader))
    row = text.select(parsed.alias("r")).select("r.*").select(*slots).first()
    return [name for name in row if name is not None]


def _checked(reader: Mapping[str, Any] | None) -> dict[str, Any]:
    reader = dict(reader or {})
    reader.setdefault("header", 0 if not reader.get("names") else None)
    if reader.get("bad_lines", "error") not in ("error", "keep"):
        raise ConfigError(f"bad_lines must be error or keep, not {reader['bad_lines']}")
    unknown = [key for key in reader if key not in READER_PARAMETERS]
    if unknown:
        raise ConfigError(f"unknown reader parameters {unknown}")
    return reader
