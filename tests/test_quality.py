"""Data-quality checks on the three-row fixture and its mutations."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerwell.errors import DataQualityError
from layerwell.operators import quality as dq

SCHEMA = "id long, value long, category string, user_id string, timestamp timestamp"
ROWS = [
    (1, 10, "A", "user_001", datetime(2024, 1, 1)),
    (2, 20, "B", "user_002", datetime(2024, 1, 2)),
    (3, 30, "A", "user_003", datetime(2024, 1, 3)),
]


@pytest.fixture
def base(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def change(spark, row, **values):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    rows = [list(r) for r in ROWS]
    for name, value in values.items():
        rows[row][names.index(name)] = value
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA)


def failing(df, *checks):
    return [r.failing for r in dq.collect_results(dq.run_checks(df, list(checks)))]


def critical(df, check):
    with pytest.raises(DataQualityError):
        dq.enforce(dq.collect_results(dq.run_checks(df, [check])))


def test_required_columns(base):
    assert failing(base, dq.required_columns(base, ["id", "value"])) == [0]
    critical(base, dq.required_columns(base, ["missing_col"]))
    with pytest.raises(DataQualityError, match="missing_col"):
        dq.enforce_schema_checks(dq.required_columns(base, ["missing_col"]))


def test_not_null(spark, base):
    assert failing(base, dq.not_null("value")) == [0]
    critical(change(spark, 0, value=None), dq.not_null("value"))


def test_not_null_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert failing(df, dq.not_null("x", df.schema["x"].dataType)) == [2]


def test_key_uniqueness(spark, base):
    (good,) = dq.collect_results(dq.key_uniqueness(base, ["id"]))
    assert good.passed and good.total == 3
    twice = change(spark, 2, id=1)
    (bad,) = dq.collect_results(dq.key_uniqueness(twice, ["id"]))
    assert (bad.failing, bad.passed) == (2, False)
    assert dq.duplicate_rows(twice, ["id"]).count() == 2
    with pytest.raises(DataQualityError):
        dq.enforce([bad])


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 2)], "a long, b long")
    assert dq.collect_results(dq.key_uniqueness(df, ["a", "b"]))[0].failing == 2
    assert dq.duplicate_rows(df, ["a", "b"]).count() == 2


def test_keys_exist(base):
    critical(base, dq.primary_keys_exist(base, ["nope"]))
    critical(base, dq.partition_keys_exist(base, ["nope"]))
    assert failing(base, dq.primary_keys_exist(base, ["id"]), dq.partition_keys_exist(base, ["category"])) == [0, 0]


def test_types_and_extra_columns(base):
    assert failing(base, dq.column_types(base, {"id": "float"})) == [1]
    assert failing(base, dq.column_types(base, {"id": "int", "timestamp": "datetime", "absent": "int"})) == [0]
    assert failing(base, dq.column_types(base, {"id": "string"})) == [0]
    assert failing(base, dq.extra_columns(base, ["id"])) == [4]


def test_record_timestamp(spark, base):
    assert failing(base, dq.record_timestamp(base, "missing")) == [1]
    nulls = change(spark, 1, timestamp=None)
    assert failing(nulls, dq.record_timestamp(nulls, "timestamp")) == [1]


def test_range(spark, base):
    assert failing(base, dq.value_range("value", 15, 25)) == [2]
    assert failing(base, dq.value_range("value", 10, 30)) == [0]
    assert failing(change(spark, 0, value=None), dq.value_range("value", 15, 25)) == [1]
    nan = spark.createDataFrame([(float("nan"),), (5.0,)], "x double")
    assert failing(nan, dq.value_range("x", 0.0, 1.0)) == [1]


def test_categories(spark, base):
    assert failing(base, dq.valid_categories("category", ["A"])) == [1]
    assert failing(change(spark, 0, category=None), dq.valid_categories("category", ["A"])) == [2]


def test_format(spark, base):
    pattern = r"user_\d{4}"
    assert failing(base, dq.string_format("user_id", pattern)) == [3]
    assert failing(base, dq.string_format("user_id", r"user_\d")) == [0]
    assert failing(base, dq.string_format("user_id", r"x|ser_")) == [3]
    assert failing(change(spark, 0, user_id=None), dq.string_format("user_id", "user")) == [1]


def test_not_negative(spark):
    assert failing(change(spark, 0, value=-5), dq.not_negative("value")) == [1]
    assert failing(change(spark, 0, value=None), dq.not_negative("value")) == [0]


def test_coverage(base):
    gaps = dq.missing_days(base, "timestamp", date(2024, 1, 1), date(2024, 1, 4))
    assert [r["day"] for r in gaps.collect()] == [date(2024, 1, 4)]
    (result,) = dq.collect_results(dq.completeness(gaps, "date_range_coverage", "timestamp"))
    assert (result.failing, result.passed, result.severity) == (1, False, "warning")


def test_completeness_can_be_critical(base, spark):
    expected = spark.createDataFrame([("A",), ("B",), ("C",)], "category string")
    gaps = dq.missing_members(base, expected, ["category"])
    results = dq.collect_results(dq.completeness(gaps, "completeness", "category", dq.CRITICAL))
    with pytest.raises(DataQualityError):
        dq.enforce(results)


def test_future_and_recency(spark, base):
    now = datetime(2024, 1, 3, 12)
    assert failing(base, dq.no_future_dates("timestamp", now)) == [0]
    later = change(spark, 0, timestamp=now + timedelta(days=1))
    assert failing(later, dq.no_future_dates("timestamp", now)) == [1]
    day = timedelta(days=1)
    assert failing(base, dq.data_recency("timestamp", now, day)) == [0]
    assert failing(base, dq.data_recency("timestamp", now + 2 * day, day)) == [1]
    assert failing(base.where("id < 0"), dq.data_recency("timestamp", now, day)) == [0]


def test_warnings_do_not_raise(base):
    results = dq.enforce(dq.collect_results(dq.run_checks(base, [dq.not_negative("id"), dq.value_range("value", 15, 25)])))
    assert [r.passed for r in results] == [True, False]


def test_observed_checks_equal_run_checks(base, tmp_path):
    checks = [
        dq.required_columns(base, ["id"]), dq.not_null("id"), dq.value_range("value", 15, 25),
        dq.data_recency("timestamp", datetime(2024, 2, 1), timedelta(days=1)),
    ]
    observed, observation = dq.observe_checks(base, checks)
    observed.write.parquet(str(tmp_path / "out"))
    assert dq.observed_results(checks, observation) == dq.collect_results(dq.run_checks(base, checks))


def test_all_checks_share_one_pass_without_exchange_of_rows(base):
    plan = dq.run_checks(base.repartition(3).where(F.col("id") > 0), [
        dq.not_null("id"), dq.not_negative("value"), dq.value_range("value", 1, 2),
    ])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
