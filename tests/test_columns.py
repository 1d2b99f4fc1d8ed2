"""Functions and schema operators on small frames."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from layerwell.errors import ConfigError
from layerwell.functions.casting import lenient_cast, spark_type
from layerwell.functions.dates import between_inclusive
from layerwell.functions.text import normalize_strings
from layerwell.operators.lineage import add_bronze_lineage, add_silver_lineage
from layerwell.operators.schema import enforce_schema, rename_columns
from layerwell.plans.builders import compact_dates, month_names
from layerwell.spec import PipelineConfig, SourceSpec, TableSpec

CLOCK = datetime(2026, 2, 16, 12, tzinfo=timezone.utc)


def values(df, column):
    return [row[column] for row in df.collect()]


def test_compact_dates_text_and_numbers(spark):
    df = spark.createDataFrame([("20240115",), ("20240201",)], "event_date string")
    out = df.transform(compact_dates("event_date"))
    assert values(out, "event_date") == [datetime(2024, 1, 15), datetime(2024, 2, 1)]
    numbers = spark.createDataFrame([(20240115,)], "event_date long").transform(compact_dates("event_date"))
    assert values(numbers, "event_date") == [datetime(2024, 1, 15)]


@pytest.mark.parametrize("bad", ["invalid_date", "2024011", "20240230", "20240115.0", "", None])
def test_compact_dates_invalid(spark, bad):
    df = spark.createDataFrame([("20240115",), (bad,)], "event_date string")
    assert values(df.transform(compact_dates("event_date")), "event_date") == [datetime(2024, 1, 15), None]


def test_compact_dates_absent_column(spark):
    df = spark.createDataFrame([(1,), (2,)], "some_other_column long")
    assert df.transform(compact_dates("event_date")).collect() == df.collect()


def test_month_names(spark):
    df = spark.createDataFrame(
        [("January", 2026, 10), ("february", 2026, 20), ("MARCH", 2026, 30), ("Foo", 2026, 1),
         ("Jan", 2026, 1), (None, 2026, 1), ("May", None, 1)],
        "MONTH string, YEAR long, value long",
    )
    out = df.transform(month_names("MONTH", "YEAR", "month_start_date"))
    assert out.columns == ["MONTH", "YEAR", "value", "month_start_date"]
    assert values(out, "month_start_date") == [
        datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1), None, None, None, None
    ]


def test_month_names_absent_column(spark):
    df = spark.createDataFrame([("January",)], "MONTH string")
    assert df.transform(month_names("MONTH", "YEAR", "month_start_date")).columns == ["MONTH"]


def test_rename_ignores_absent_sources(spark):
    spec = TableSpec.from_mapping(
        "t", {"columns": {"new_col": {"source": "old_col"}, "other": {"source": "nowhere"}}}
    )
    df = spark.createDataFrame([(1, 3), (2, 4)], "old_col long, keep_col long")
    out = rename_columns(df, spec)
    assert out.columns == ["new_col", "keep_col"]
    assert values(out, "new_col") == [1, 2]


def test_normalize_strings_strips_all_white_space(spark):
    df = spark.createDataFrame(
        [("  a ", 1), ("b  ", 2), ("\t c d \n", 3), (" \t", 4), (None, 5)],
        "col1 string, col2 long",
    )
    assert values(normalize_strings(df), "col1") == ["a", "b", "c d", "", None]


def test_enforce_schema(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "2024-01-01", 7), ("2", "2.5", "2024-01-02", 8), ("x", "NaN", "soon", 9)],
        "int_col string, float_col string, datetime_col string, extra_col long",
    )
    dtypes = {
        "int_col": "int", "float_col": "float", "datetime_col": "datetime", "missing_col": "str"
    }
    out = enforce_schema(df, dtypes)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("int_col", "bigint"), ("float_col", "double"), ("datetime_col", "timestamp"),
        ("missing_col", "string"),
    ]
    assert [tuple(r) for r in out.collect()] == [
        (1, 1.5, datetime(2024, 1, 1), None),
        (2, 2.5, datetime(2024, 1, 2), None),
        (None, None, None, None),
    ]


def test_enforce_schema_null_column(spark):
    df = spark.createDataFrame(
        [("1", "5", "2024-01-01"), ("x", "6", "bad")], "a string, b string, c string"
    )
    out = enforce_schema(df, {"a": "Int64", "b": "Int64", "c": "datetime64[ns]"}, on_error="null_column")
    assert [tuple(r) for r in out.collect()] == [
        (None, 5, datetime(2024, 1, 1)), (None, 6, None)
    ]


def test_numbers_never_truncate(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (None,), (float("nan"),)], "x double")
    cast = lenient_cast(F.col("x"), spark_type("float64"), spark_type("Int64"))
    assert [r[0] for r in df.select(cast).collect()] == [1, None, None, None]


def test_unknown_type():
    with pytest.raises(ConfigError):
        spark_type("decimal")


def test_lineage(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "col1 long, col2 string")
    bronze = add_bronze_lineage(df, "feed", "file.csv", "run1", CLOCK)
    assert bronze.columns == [
        "col1", "col2", "_bronze_ingested_at", "_source_name", "_source_file", "_bronze_run_id"
    ]
    assert set(values(bronze, "_source_file")) == {"file.csv"}
    silver = add_silver_lineage(bronze, "run2", CLOCK)
    row = silver.first()
    assert (row["_silver_run_id"], row["_bronze_run_id"]) == ("run2", "run1")
    bare = add_silver_lineage(df, "run2", CLOCK).first()
    assert bare["_bronze_run_id"] is None and bare["_bronze_ingested_at"] is None


def test_between_inclusive(spark):
    df = spark.createDataFrame([(date(2026, 1, d),) for d in range(1, 6)] + [(None,)], "d date")
    kept = df.where(between_inclusive(F.col("d"), date(2026, 1, 2), date(2026, 1, 4)))
    assert values(kept, "d") == [date(2026, 1, d) for d in (2, 3, 4)]


def test_record_timestamp_role():
    def spec(*flags):
        columns = {f"c{i}": {"record_timestamp": flag} for i, flag in enumerate(flags)}
        return TableSpec.from_mapping("t", {"columns": columns})

    assert spec(False, False).record_timestamp is None
    assert spec(False, True).record_timestamp == "c1"
    with pytest.raises(ConfigError):
        spec(True, True).record_timestamp


def test_source_spec_errors():
    with pytest.raises(ConfigError):
        SourceSpec.from_mapping("s", {"ingestion_mode": "sometimes", "acquisition_method": "manual_drop"})
    with pytest.raises(ConfigError):
        SourceSpec.from_mapping("s", {"ingestion_mode": "append", "acquisition_method": "pigeon"})


def test_config_from_folder(tmp_path):
    (tmp_path / "pipeline.yaml").write_text(
        'pipeline:\n  name: p\n  timezone: UTC\n  execution:\n    start_date: "2026-01-01"\n'
    )
    (tmp_path / "sources.yaml").write_text(
        "sources:\n  feed:\n    aquisition_method: manual_drop\n    ingestion_mode: append\n"
        "    file_type: csv\n    reader: {header: null, names: [a, b]}\n"
    )
    (tmp_path / "schemas.yaml").write_text(
        "schemas:\n  bronze:\n    feed: {required_columns: [a]}\n  silver:\n    feed:\n"
        "      columns:\n        id: {source: a, type: string, nullable: false, primary_key: true}\n"
    )
    config = PipelineConfig.from_folder(tmp_path)
    assert config.window(CLOCK) == (date(2026, 1, 1), CLOCK)
    assert config.silver["feed"].primary_keys == ["id"]
    assert config.source("feed").reader["names"] == ["a", "b"]
    with pytest.raises(ConfigError):
        config.source("unknown")
