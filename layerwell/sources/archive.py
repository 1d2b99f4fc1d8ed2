"""Lines of text files inside zip archives."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Send the functions below to Python workers as code, so that clusters need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINES_PER_BATCH = 20_000
LINE_SCHEMA = "path string, line_no bigint, line string"


def archive_lines(files: DataFrame, encoding: str = "utf-8", quote: str | None = None) -> DataFrame:
    """One row per line of the single member of each archive in ``content``.

    The member is unpacked as a stream, so a task holds the compressed archive
    and one batch of lines. With ``quote``, line breaks inside quoted text do
    not end a record.
    """

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                yield from _line_batches(path.as_py(), content.as_buffer(), encoding, quote)

    return files.select("path", "content").mapInArrow(unpack, LINE_SCHEMA)


def _line_batches(path: str, content, encoding: str, quote: str | None):
    with zipfile.ZipFile(pa.BufferReader(content)) as archive:
        members = [m for m in archive.infolist() if not m.is_dir()]
        if len(members) != 1:
            raise ValueError(f"{path}: expected one file in the archive, found {len(members)}")
        with archive.open(members[0]) as raw:
            text = io.TextIOWrapper(raw, encoding=encoding, newline=None)
            pending: list[str] = []
            first = 0
            for record in _records(text, quote):
                pending.append(record)
                if len(pending) == LINES_PER_BATCH:
                    yield _batch(path, first, pending)
                    first, pending = first + len(pending), []
            if pending:
                yield _batch(path, first, pending)


def _records(text: Iterable[str], quote: str | None) -> Iterator[str]:
    held = ""
    for line in text:
        held += line
        if quote and held.count(quote) % 2:
            continue
        yield held.rstrip("\n")
        held = ""
    if held:
        yield held.rstrip("\n")


def _batch(path: str, first: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * len(lines), pa.string()),
            pa.array(range(first, first + len(lines)), pa.int64()),
            pa.array(lines, pa.string()),
        ],
        names=["path", "line_no", "line"],
    )
