"""Readers, listings, calendars and manifests."""

import gzip
import io
import os
import zipfile
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from layerwell.errors import ConfigError
from layerwell.plans.packing import workbook_bytes, zip_bytes
from layerwell.sources.delimited import read_delimited, read_zipped_delimited
from layerwell.sources.listing import (
    expected_files,
    files_to_acquire,
    key_collisions,
    list_files,
    new_files,
    newest_file,
    source_key,
)
from layerwell.sources.manifest import load_manifest, record_files
from layerwell.sources.tabular import read_files
from layerwell.sources.workbook import read_workbooks
from layerwell.spec import SourceSpec

TSV = {"sep": "\t", "header": None, "names": ["a", "b", "c"], "skipinitialspace": True}
CLOCK = datetime(2026, 2, 16, tzinfo=timezone.utc)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def ordered(df, *columns):
    return [tuple(r) for r in df.orderBy("_source_file", "_source_position").select(*columns).collect()]


def test_delimited_text(spark, tmp_path):
    (tmp_path / "20260101.export.csv").write_text('1\t x\t"q ""z"""\n2\t\tNA\n3\n')
    out = read_delimited(spark, [str(tmp_path)], TSV)
    assert ordered(out, "a", "b", "c") == [("1", "x", 'q "z"'), ("2", None, "NA"), ("3", None, None)]
    assert {r["_source_file"] for r in out.collect()} == {"20260101.export.csv"}
    marked = read_delimited(spark, [str(tmp_path)], {**TSV, "null_values": ["NA"]})
    assert ordered(marked, "c")[1] == (None,)


def test_file_names_are_decoded(spark, tmp_path):
    (tmp_path / "a b+c%d.csv").write_text("1\t2\t3\n")
    out = read_delimited(spark, [str(tmp_path)], TSV)
    assert rows(out, "_source_file") == [("a b+c%d.csv",)]


def test_header_and_gzip(spark, tmp_path):
    (tmp_path / "x.csv.gz").write_bytes(gzip.compress(b"k,v\n1,one\n2,two\n"))
    assert rows(read_delimited(spark, [str(tmp_path)], {"header": 0}), "k", "v") == [("1", "one"), ("2", "two")]
    renamed = read_delimited(spark, [str(tmp_path)], {"header": 0, "names": ["p", "q"]})
    assert rows(renamed, "p", "q") == [("1", "one"), ("2", "two")]


def test_reader_parameters_are_checked(spark):
    with pytest.raises(ConfigError):
        read_delimited(spark, ["x"], {"header": None})
    with pytest.raises(ConfigError):
        read_delimited(spark, ["x"], {"separator": ";"})


def test_positions_keep_the_order_of_split_files(spark, tmp_path):
    lines = [f"{i}\t{'x' * 40}\ty" for i in range(20_000)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        out = read_delimited(spark, [str(tmp_path)], TSV)
        assert out.rdd.getNumPartitions() > 1
        assert [int(a) for (a,) in ordered(out, "a")] == list(range(20_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_zipped_text(spark, tmp_path):
    for day, text in (("01", '1\t x\t"q ""z"""\n2\t\tNA\n'), ("02", "3\ty\tz")):
        (tmp_path / f"202601{day}.export.CSV.zip").write_bytes(zip_bytes({"d/in.csv": text}))
    out = read_zipped_delimited(spark, [str(tmp_path)], TSV)
    assert ordered(out, "a", "b", "c", "_source_file") == [
        ("1", "x", 'q "z"', "20260101.export.CSV.zip"),
        ("2", None, "NA", "20260101.export.CSV.zip"),
        ("3", "y", "z", "20260102.export.CSV.zip"),
    ]


def test_zipped_text_with_header_and_line_breaks(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(zip_bytes({"x.csv": 'k,v\n1,"a\nb"\n2,c\n'}))
    out = read_zipped_delimited(spark, [str(tmp_path)], {"header": 0, "multi_line": True})
    assert rows(out, "k", "v") == [("1", "a\nb"), ("2", "c")]


def test_empty_zip_member_gives_no_rows(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(zip_bytes({"x.csv": ""}))
    assert read_zipped_delimited(spark, [str(tmp_path)], TSV).count() == 0


def test_zip_needs_one_member(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(zip_bytes({"a.csv": "1", "b.csv": "2"}))
    with pytest.raises(Exception, match="expected one file"):
        read_zipped_delimited(spark, [str(tmp_path)], TSV).collect()


def test_spread_archives_give_the_same_rows(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.zip").write_bytes(zip_bytes({"x.csv": "1\t2\t3\n4\t5\t6\n"}))
    plain = read_zipped_delimited(spark, [str(tmp_path)], TSV)
    spread = read_zipped_delimited(spark, [str(tmp_path)], {**TSV, "spread": True})
    assert rows(spread, "a", "_source_file", "_source_position") == rows(plain, "a", "_source_file", "_source_position")


def test_zipped_text_longer_than_a_batch(spark, tmp_path):
    text = "".join(f"{i}\tx\ty\n" for i in range(45_000))
    (tmp_path / "x.zip").write_bytes(zip_bytes({"x.csv": text}))
    out = read_zipped_delimited(spark, [str(tmp_path)], TSV)
    assert [int(a) for (a,) in ordered(out, "a")] == list(range(45_000))


def test_workbook(spark, tmp_path):
    data = [["COUNTRY", "MONTH", "YEAR", "EVENTS"], ["Chad", "January", 2026, 5], ["Mali & Co", None, 2026, 1.5]]
    (tmp_path / "snapshot.xlsx").write_bytes(workbook_bytes(data))
    out = read_workbooks(spark, [str(tmp_path)], {"sheet_name": 0, "header": 0})
    assert out.columns[:4] == ["COUNTRY", "MONTH", "YEAR", "EVENTS"]
    assert rows(out, "COUNTRY", "MONTH", "YEAR", "EVENTS") == [
        ("Chad", "January", "2026", "5"), ("Mali & Co", None, "2026", "1.5")
    ]


def test_workbooks_are_united_by_name(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes([["skip"], ["x", "y"], [1, 2]]))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes([["skip"], ["y", "z"], [3, 4]]))
    out = read_workbooks(spark, [str(tmp_path)], {"header": 1})
    assert rows(out, "x", "y", "z", "_source_file") == [("1", "2", None, "a.xlsx"), (None, "3", "4", "b.xlsx")]


def test_zipped_workbook_in_a_folder(spark, tmp_path):
    inner = workbook_bytes([["x"], [1]])
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("notes.txt", "n")
        archive.writestr("deep/book.xlsx", inner)
    (tmp_path / "x.zip").write_bytes(buffer.getvalue())
    assert rows(read_workbooks(spark, [str(tmp_path)], zipped=True), "x") == [("1",)]


def test_workbook_shared_strings_dates_gaps_and_duplicates(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    (tmp_path / "x.xlsx").write_bytes(zip_bytes({
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>'
        '<sheet name="First" r:id="r1"/><sheet name="Second" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}">'
        '<Relationship Id="r1" Target="/xl/worksheets/s1.xml"/>'
        '<Relationship Id="r2" Target="worksheets/s2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><t>name</t></si>'
        "<si><r><t>rich </t></r><r><t>text</t></r></si></sst>",
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><numFmts>'
        '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;d&quot;"/>'
        '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>',
        "xl/worksheets/s1.xml": f'<worksheet xmlns="{main}"><sheetData/></worksheet>',
        "xl/worksheets/s2.xml": f'<worksheet xmlns="{main}"><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>0</v></c><c r="D1" t="inlineStr"><is><t>ok</t></is></c></row>'
        '<row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3" s="1"><v>46054</v></c><c r="C3" s="2"><v>2</v></c>'
        '<c r="D3" t="b"><v>1</v></c></row></sheetData></worksheet>',
    }))
    out = read_workbooks(spark, [str(tmp_path)], {"sheet_name": "Second"})
    assert rows(out, "name", "`name.1`", "`Unnamed: 2`", "ok") == [
        ("rich text", "2026-02-01 00:00:00", "2", "True")
    ]


def test_parquet_files_with_differing_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x long, y string").write.parquet(str(tmp_path / "1"))
    spark.createDataFrame([(2, 0.5)], "x long, z double").write.parquet(str(tmp_path / "2"))
    source = SourceSpec("s", "append", file_type="parquet", compression="gzip")
    out = read_files(spark, [str(tmp_path / "1"), str(tmp_path / "2")], source)
    assert rows(out, "x", "y", "z") == [(1, "a", None), (2, None, 0.5)]


def test_unsupported_file_type(spark):
    with pytest.raises(ConfigError):
        read_files(spark, ["x"], SourceSpec("s", "append", file_type="xls"))


# --------------------------------------------------------------- listings etc.


def test_source_keys(spark):
    names = ["sales-07.tsv.zip", "sales-07.tsv", "q3 report.xlsx", "a.b.csv.gz", "README", ".draft.tsv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    keys = [r[0] for r in df.select(source_key(F.col("n"))).collect()]
    assert keys == ["sales-07", "sales-07", "q3 report", "a", "README", ".draft"]


def test_listing(spark, tmp_path):
    assert list_files(spark, str(tmp_path / "absent")).count() == 0
    (tmp_path / "sub").mkdir()
    for at, name in ((100, "b.csv"), (300, "a.csv"), (200, "sub/c d.csv")):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (at, at))
    listing = list_files(spark, str(tmp_path))
    assert rows(listing, "file_name", "source_key", "length") == [("a.csv", "a", 1), ("b.csv", "b", 1), ("c d.csv", "c d", 1)]
    assert rows(newest_file(listing), "file_name") == [("a.csv",)]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    assert list_files(spark, str(tmp_path), pattern="b*").count() == 1


def test_new_files_and_manifest(spark, tmp_path):
    path = str(tmp_path / "m")
    listing = spark.createDataFrame(
        [("a.csv", "a", CLOCK), ("b.csv", "b", CLOCK)], "path string, source_key string, modified_at timestamp"
    )
    assert load_manifest(spark, path).count() == 0
    record_files(listing.where("path = 'a.csv'"), path, "r1", CLOCK)
    assert rows(new_files(listing, load_manifest(spark, path)), "path") == [("b.csv",)]
    record_files(listing, path, "r2", CLOCK)
    assert rows(load_manifest(spark, path), "path", "run_id") == [("a.csv", "r1"), ("b.csv", "r2")]


def test_key_collisions(spark):
    listing = spark.createDataFrame(
        [("d/a.csv", "a"), ("d/a.xlsx", "a"), ("d/b.csv", "b")], "path string, source_key string"
    )
    assert rows(key_collisions(listing), "source_key", "files") == [("a", 2)]


def test_expected_files(spark):
    files = expected_files(
        spark, date(2026, 2, 27), date(2026, 3, 1), "{year}{month:02d}{day:02d}.export.CSV.zip", "http://h/e"
    )
    assert rows(files, "day", "file_name") == [
        (date(2026, 2, 27), "20260227.export.CSV.zip"),
        (date(2026, 2, 28), "20260228.export.CSV.zip"),
        (date(2026, 3, 1), "20260301.export.CSV.zip"),
    ]
    assert files.first()["url"] == "http://h/e/20260227.export.CSV.zip"
    present = spark.createDataFrame([("20260228",)], "source_key string")
    assert rows(files_to_acquire(files, present), "day") == [(date(2026, 2, 27),), (date(2026, 3, 1),)]


def test_expected_files_with_named_formats(spark):
    files = expected_files(
        spark, date(2026, 2, 3), date(2026, 2, 3), "as-of-{day:02d}{month_abbr}{year}.xlsx",
        date_formats={"month_abbr": "%b"},
    )
    assert rows(files, "file_name") == [("as-of-03Feb2026.xlsx",)]
    with pytest.raises(ConfigError):
        expected_files(spark, date(2026, 2, 3), date(2026, 2, 3), "{hour}.csv")


def test_naive_bounds_are_refused(spark):
    with pytest.raises(ValueError):
        expected_files(spark, datetime(2026, 2, 3), date(2026, 2, 4), "{year}")
    assert expected_files(spark, CLOCK, CLOCK, "{day}").count() == 1
