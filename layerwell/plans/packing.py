"""Packing rows into archives and workbooks, to have files of these kinds to read."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle

# Send the functions below to Python workers as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def zip_batches(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for number, batch in enumerate(batches):
        packed = zip_bytes({"export.csv": "\n".join(batch["line"]) + "\n"})
        yield pd.DataFrame({"path": [f"batch-{number}.csv.zip"], "content": [packed]})


def workbook_batches(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for number, batch in enumerate(batches):
        packed = workbook_bytes([list(batch.columns), *batch.itertuples(index=False)])
        yield pd.DataFrame({"path": [f"batch-{number}.xlsx"], "content": [packed]})


def zip_bytes(members: dict[str, str]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return buffer.getvalue()


def workbook_bytes(rows: Iterable[Iterable]) -> bytes:
    """A minimal workbook of one sheet with inline text and numbers."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    body = "".join(
        "<row>" + "".join(_cell(value) for value in row) + "</row>" for row in rows
    )
    return zip_bytes(
        {
            "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>'
            '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}">'
            '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}">'
            f"<sheetData>{body}</sheetData></worksheet>",
        }
    )


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, str):
        return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
    return f"<c><v>{value!r}</v></c>" if isinstance(value, float) else f"<c><v>{value}</v></c>"
