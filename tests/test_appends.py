"""Tables that grow by appends and fold themselves."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layerwell.errors import DataQualityError
from layerwell.sinks import appends
from layerwell.sinks.appends import append_rows, appended_rows, fold
from layerwell.sinks.parquet import write_partitions, write_table
from layerwell.sources.table_log import Files, table_state
from layerwell.sources.tables import read_table

SCHEMA = "crate long, dock string"


def crates(spark, *numbers):
    return spark.createDataFrame([(n, f"d{n % 3}") for n in numbers], SCHEMA).coalesce(1)


def numbers(df):
    return sorted(r["crate"] for r in df.select("crate").collect())


def parquet_files(path):
    return [p for p in path.rglob("*.parquet")]


def test_a_hundred_appends_leave_few_files(spark, tmp_path):
    path = tmp_path / "t"
    for n in range(100):
        append_rows(crates(spark, n), str(path), fold_after=8)
    assert numbers(read_table(spark, str(path))) == list(range(100))
    state = table_state(spark, str(path))
    assert len(state.locations("")) <= 16
    assert len(parquet_files(path)) <= 32  # with those that the last fold retired
    assert len(list((path / "_log").glob("[0-9]*.json"))) <= appends.KEPT


def test_large_folders_are_left_alone():
    assert appends._first_to_fold([1000, 1, 1, 1, 1], 4) == 1
    assert appends._first_to_fold([8, 1, 1, 1, 1], 4) == 0
    assert appends._first_to_fold([1, 1], 20) == 0


def test_readers_can_finish_during_a_fold(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        append_rows(crates(spark, n), path)
    begun = appended_rows(spark, path, spark.createDataFrame([], SCHEMA).schema)
    assert fold(spark, path)
    assert numbers(begun) == numbers(read_table(spark, path)) == [0, 1, 2]


def test_a_failed_append_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    append_rows(crates(spark, 1), path)
    with pytest.raises(PySparkException, match="broken"):
        append_rows(crates(spark, 2).withColumn("dock", F.raise_error(F.lit("broken")).cast("string")), path)
    assert numbers(read_table(spark, path)) == [1]


def test_an_append_that_loses_a_race_is_kept(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_rows(crates(spark, 1), path)
    real, rivals = appends.record, [crates(spark, 2)]

    def late(files, place, before, after, kept):
        if rivals:
            append_rows(rivals.pop(), path)
        return real(files, place, before, after, kept)

    monkeypatch.setattr(appends, "record", late)
    append_rows(crates(spark, 3), path)
    assert numbers(read_table(spark, path)) == [1, 2, 3]


def test_a_fold_that_loses_a_race_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(3):
        append_rows(crates(spark, n), path)
    real, rivals = appends.record, [crates(spark, 7)]

    def late(files, place, before, after, kept):
        if rivals:
            append_rows(rivals.pop(), path)
        return real(files, place, before, after, kept)

    monkeypatch.setattr(appends, "record", late)
    assert not fold(spark, path)
    assert numbers(read_table(spark, path)) == [0, 1, 2, 7]
    assert fold(spark, path)
    assert numbers(read_table(spark, path)) == [0, 1, 2, 7]


def test_files_without_a_log_move_into_one(spark, tmp_path):
    path = str(tmp_path / "t")
    crates(spark, 1, 2).write.parquet(path)
    assert numbers(appended_rows(spark, path, crates(spark).schema)) == [1, 2]
    append_rows(crates(spark, 3), path)
    assert numbers(read_table(spark, path)) == [1, 2, 3]
    assert numbers(appended_rows(spark, path, crates(spark).schema)) == [1, 2, 3]


def test_columns_may_be_added_but_not_change(spark, tmp_path):
    path = str(tmp_path / "t")
    append_rows(crates(spark, 1), path)
    append_rows(crates(spark, 2).withColumn("weight", F.lit(2.5)), path)
    fold(spark, path)
    found = read_table(spark, path).orderBy("crate").collect()
    assert [r["weight"] for r in found] == [None, 2.5]
    with pytest.raises(DataQualityError, match="dock"):
        append_rows(crates(spark, 3).withColumn("dock", F.lit(1)), path)


def test_empty_appends_and_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    assert appended_rows(spark, path, crates(spark).schema).count() == 0
    append_rows(crates(spark), path)
    append_rows(crates(spark, 4), path)
    assert numbers(read_table(spark, path)) == [4]
    write_table(crates(spark, 5), path)
    append_rows(read_table(spark, path).withColumn("crate", F.col("crate") + 1), path)
    assert numbers(read_table(spark, path)) == [5, 6]


def test_a_table_of_partitions_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(crates(spark, 1), path, ["dock"])
    with pytest.raises(DataQualityError, match="partitions"):
        append_rows(crates(spark, 2), path)
    assert Files(spark, path).size(path) > 0
