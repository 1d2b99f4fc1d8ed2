"""Spreadsheets (xlsx), read many at a time.

An xlsx file is a zip archive of XML parts. Each task decodes whole workbooks
with the standard library, streaming the sheet so that rows leave as they are
parsed. Cells come out as text in a name-to-value map; Spark does the rest.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterable, Iterator, Mapping, Sequence
from datetime import datetime, timedelta
from typing import Any
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from layerwell.errors import ConfigError
from layerwell.operators.lineage import SOURCE_FILE, SOURCE_POSITION

# Send the functions below to Python workers as code, so that clusters need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 5_000
ROW_SCHEMA = "path string, row_no bigint, names array<string>, cells array<string>"

# Namespaces, part names and built-in date formats of the file format.
MAIN_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
WORKBOOK_PART = "xl/workbook.xml"
RELATIONS_PART = "xl/_rels/workbook.xml.rels"
STRINGS_PART = "xl/sharedStrings.xml"
STYLES_PART = "xl/styles.xml"
BUILT_IN_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
DAY_ZERO = datetime(1899, 12, 30)
DAY_ZERO_1904 = datetime(1904, 1, 1)


def read_workbooks(
    spark: SparkSession,
    paths: Sequence[str],
    reader: Mapping[str, Any] | None = None,
    zipped: bool = False,
) -> DataFrame:
    """Rows of one sheet of every workbook, columns united by name."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return parse_workbooks(files, reader, zipped)


def parse_workbooks(
    files: DataFrame, reader: Mapping[str, Any] | None = None, zipped: bool = False
) -> DataFrame:
    """As :func:`read_workbooks` for rows of ``path`` and ``content``.

    ``sheet_name`` is an index or a name, ``header`` the row that holds the
    names. Without ``names`` a first pass over the headers finds the columns.
    """
    reader = dict(reader or {})
    sheet, header = reader.pop("sheet_name", 0), reader.pop("header", 0)
    names = reader.pop("names", None)
    if reader:
        raise ConfigError(f"unknown reader parameters {list(reader)}")

    if not names:
        heads = _decode(files, sheet, header, zipped, header_only=True)
        found = heads.select(F.posexplode("names")).groupBy("col").agg(F.min("pos").alias("pos"))
        names = [row["col"] for row in found.orderBy("pos", "col").collect()]
    rows = _decode(files, sheet, header, zipped, header_only=False).withColumn(
        "by_name", F.map_from_arrays("names", "cells")
    )
    return rows.select(
        *(F.col("by_name").getItem(name).alias(name) for name in names),
        F.substring_index("path", "/", -1).alias(SOURCE_FILE),
        F.struct(F.lit(0).cast("bigint").alias("block"), F.col("row_no").alias("row")).alias(
            SOURCE_POSITION
        ),
    )


def _decode(files: DataFrame, sheet, header: int, zipped: bool, header_only: bool) -> DataFrame:
    def decode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _workbook_batches(path, content, sheet, header, zipped, header_only)

    return files.select("path", "content").mapInPandas(decode, ROW_SCHEMA)


def _workbook_batches(path, content, sheet, header, zipped, header_only):
    if zipped:
        content = _inner_workbook(path, content)
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        rows = _sheet_rows(book, sheet)
        for _ in range(header):
            next(rows, None)
        names = _unique_names(next(rows, []))
        if header_only:
            yield pd.DataFrame({"path": [path], "row_no": [0], "names": [names], "cells": [[]]})
            return
        pending: list[list[str | None]] = []
        first = 0
        for row in rows:
            if any(cell is not None for cell in row[len(names) :]):
                raise ValueError(f"{path} has cells beyond its header of {len(names)} columns")
            if any(cell is not None for cell in row):
                pending.append((row + [None] * len(names))[: len(names)])
            if len(pending) == ROWS_PER_BATCH:
                yield _frame(path, first, names, pending)
                first, pending = first + len(pending), []
        if pending:
            yield _frame(path, first, names, pending)


def _frame(path, first, names, rows) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "path": [path] * len(rows),
            "row_no": range(first, first + len(rows)),
            "names": [names] * len(rows),
            "cells": rows,
        }
    )


def _inner_workbook(path: str, content: bytes) -> bytes:
    with zipfile.ZipFile(io.BytesIO(content)) as outer:
        for name in outer.namelist():
            if name.lower().endswith(".xlsx"):
                return outer.read(name)
    raise ValueError(f"{path}: no workbook in the archive")


def _unique_names(cells: Sequence[str | None]) -> list[str]:
    """Column names; blanks are numbered, repeated names get a suffix."""
    names: list[str] = []
    for position, cell in enumerate(cells):
        base = name = cell if cell is not None else f"Unnamed: {position}"
        repeat = 0
        while name in names:
            repeat += 1
            name = f"{base}.{repeat}"
        names.append(name)
    return names


def _sheet_rows(book: zipfile.ZipFile, sheet) -> Iterator[list[str | None]]:
    part, day_zero = _sheet_part(book, sheet)
    strings, date_styles = _shared_strings(book), _date_styles(book)
    expected = 1
    with book.open(part) as xml:
        for _, element in ElementTree.iterparse(xml):
            if element.tag != f"{MAIN_NS}row":
                continue
            for _ in range(int(element.get("r", expected)) - expected):
                yield []
                expected += 1
            cells: list[str | None] = []
            for cell in element.iter(f"{MAIN_NS}c"):
                at = _column_index(cell.get("r"), len(cells))
                cells += [None] * (at - len(cells))
                cells.append(_cell_text(cell, strings, date_styles, day_zero))
            yield cells
            expected += 1
            element.clear()


def _cell_text(cell, strings, date_styles, day_zero) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{MAIN_NS}t")) or None
    value = cell.findtext(f"{MAIN_NS}v")
    if value is None or value == "" or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)] or None
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "n" and int(cell.get("s", -1)) in date_styles:
        return str(day_zero + timedelta(seconds=round(float(value) * 86_400)))
    return value


def _sheet_part(book: zipfile.ZipFile, sheet) -> tuple[str, datetime]:
    root = ElementTree.fromstring(book.read(WORKBOOK_PART))
    sheets = root.findall(f"{MAIN_NS}sheets/{MAIN_NS}sheet")
    if isinstance(sheet, int):
        chosen = sheets[sheet]
    else:
        chosen = next(s for s in sheets if s.get("name") == sheet)
    relations = ElementTree.fromstring(book.read(RELATIONS_PART))
    target = next(r.get("Target") for r in relations if r.get("Id") == chosen.get(RELATION_ID))
    options = root.find(f"{MAIN_NS}workbookPr")
    from_1904 = options is not None and options.get("date1904") in ("1", "true")
    part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return part, DAY_ZERO_1904 if from_1904 else DAY_ZERO


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if STRINGS_PART not in book.namelist():
        return []
    items = ElementTree.fromstring(book.read(STRINGS_PART)).findall(f"{MAIN_NS}si")
    # Phonetic hints (rPh) are not part of the text.
    return [
        "".join(
            t.text or ""
            for run in [item, *item.findall(f"{MAIN_NS}r")]
            for t in run.findall(f"{MAIN_NS}t")
        )
        for item in items
    ]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles that show a number as a date."""
    if STYLES_PART not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read(STYLES_PART))
    formats = set(BUILT_IN_DATE_FORMATS)
    for given in root.iter(f"{MAIN_NS}numFmt"):
        shape = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", given.get("formatCode", ""))
        if re.search(r"[dmyhs]", shape, re.IGNORECASE):
            formats.add(int(given.get("numFmtId")))
    styles = root.findall(f"{MAIN_NS}cellXfs/{MAIN_NS}xf")
    return {i for i, style in enumerate(styles) if int(style.get("numFmtId", 0)) in formats}


def _column_index(reference: str | None, following: int) -> int:
    """``B7`` is column 1; a cell without a reference follows its neighbour."""
    if not reference:
        return following
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1
