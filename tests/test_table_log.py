"""The log beside a table: whole versions, known columns, recorded changes."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layerwell.errors import DataQualityError, MissingInputError
from layerwell.sinks.parquet import merge_partitions, write_partitions, write_table
from layerwell.sources import table_log
from layerwell.sources.table_log import changes_since, commit, table_state
from layerwell.sources.tables import read_partitions, read_table, read_window

SCHEMA = "sku long, shelf string, amount long"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def shelf(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def jobs_of(spark, work):
    """Jobs that Spark starts while ``work`` makes its plan."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        made = work()
        return len(context.statusTracker().getJobIdsForGroup("counted")), made
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("keys", [[], ["shelf"]])
def test_a_failing_replacement_leaves_the_table_as_it_was(spark, tmp_path, keys):
    path = str(tmp_path / "t")
    write_table(shelf(spark, (1, "n", 5), (2, "s", 6)), path, keys)
    broken = shelf(spark, *((i, "n", i) for i in range(100))).withColumn(
        "amount", F.when(F.col("sku") == 99, F.raise_error(F.lit("halfway")).cast("long")).otherwise(F.col("sku"))
    )
    with pytest.raises(PySparkException, match="halfway"):
        write_table(broken, path, keys)
    assert rows(read_table(spark, path), "sku", "shelf", "amount") == [(1, "n", 5), (2, "s", 6)]
    write_table(shelf(spark, (3, "s", 7)), path, keys)
    assert rows(read_table(spark, path), "sku", "shelf", "amount") == [(3, "s", 7)]


def test_a_merge_that_fails_leaves_an_unpartitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_partitions(shelf(spark, (1, "n", 5)), path, [], ["sku"], None)
    broken = shelf(spark, (2, "s", 6)).withColumn("amount", F.raise_error(F.lit("halfway")).cast("long"))
    with pytest.raises(PySparkException, match="halfway"):
        merge_partitions(broken, path, [], ["sku"], None)
    assert rows(read_table(spark, path), "sku") == [(1,)]


def test_a_replacement_may_read_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(shelf(spark, (1, "n", 5)), path)
    for _ in range(3):
        write_table(read_table(spark, path).withColumn("amount", F.col("amount") + 1), path)
    assert rows(read_table(spark, path), "amount") == [(8,)]


def test_old_versions_go_but_one(spark, tmp_path):
    path = tmp_path / "t"
    for amount in range(5):
        write_table(shelf(spark, (1, "n", amount)), str(path))
        versions = [p for p in path.iterdir() if p.name.startswith("v")]
        assert len(versions) == min(amount + 1, 2)
    assert rows(read_table(spark, str(path)), "amount") == [(4,)]


def test_readers_of_the_version_before_are_not_disturbed(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(shelf(spark, (1, "n", 5)), path)
    before = read_table(spark, path)
    write_table(shelf(spark, (2, "n", 6)), path)
    assert rows(before, "sku") == [(1,)] and rows(read_table(spark, path), "sku") == [(2,)]


def test_two_writers_cannot_both_win(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(shelf(spark, (1, "n", 5)), path)
    state = table_state(spark, path)
    commit(spark, path, state, state)
    with pytest.raises(DataQualityError, match="another run"):
        commit(spark, path, state, state)
    assert table_state(spark, path).number == 2


@pytest.mark.parametrize("partitioned", [False, True])
def test_tables_without_a_log_are_taken_over(spark, tmp_path, partitioned):
    path, keys = str(tmp_path / "t"), ["shelf"] if partitioned else []
    shelf(spark, (1, "n", 5), (2, "s", 6)).write.partitionBy(*keys).parquet(path)
    assert rows(read_table(spark, path), "sku") == [(1,), (2,)]
    merge_partitions(shelf(spark, (2, "s", 7), (3, "s", 8)), path, keys, ["sku"], None, on_tie="incoming")
    assert rows(read_table(spark, path), "sku", "shelf", "amount") == [(1, "n", 5), (2, "s", 7), (3, "s", 8)]
    write_table(shelf(spark, (9, "w", 9)), path, keys)
    assert rows(read_table(spark, path), "sku") == [(9,)]
    if partitioned:
        assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("shelf=")]


def test_columns_of_the_table_and_of_later_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(shelf(spark, (1, "n", 5)), path, ["shelf"])
    write_partitions(spark.createDataFrame([(2, "s", "red")], "sku long, shelf string, colour string"), path, ["shelf"])
    want = [(1, "n", 5, None), (2, "s", None, "red")]
    assert rows(read_table(spark, path), "sku", "shelf", "amount", "colour") == want
    assert rows(read_partitions(spark, path, "shelf", ["n", "s", "gone"]), "sku", "shelf", "amount", "colour") == want
    with pytest.raises(DataQualityError, match="amount"):
        write_partitions(spark.createDataFrame([(2, "s", "6")], "sku long, shelf string, amount string"), path, ["shelf"])
    assert rows(read_table(spark, path), "sku", "shelf", "amount", "colour") == want


def test_reading_a_table_opens_no_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(20).select("id", F.date_add(F.lit(date(2026, 1, 1)), F.col("id").cast("int")).alias("day"))
    write_partitions(days, path, ["day"])
    started, window = jobs_of(spark, lambda: read_window(spark, path, "day", date(2026, 1, 3), date(2026, 1, 5)))
    assert started == 0 and window.count() == 3
    assert "PartitionFilters" in window._jdf.queryExecution().toString()
    plain = str(tmp_path / "plain")
    days.write.partitionBy("day").parquet(plain)
    assert jobs_of(spark, lambda: read_table(spark, plain))[0] > 0  # without a log


def test_a_merge_ranks_only_what_comes_in_again(spark, tmp_path):
    path = str(tmp_path / "t")

    def batch(*data):
        made = [(sku, "n", sku, date(2026, 1, day)) for sku, day in data]
        return spark.createDataFrame(made, SCHEMA + ", day date")

    def merge(*data):
        merge_partitions(batch(*data), path, ["shelf"], ["sku"], "day")

    merge(*((i, 10) for i in range(100)))
    merge(*((i, 10) for i in range(100, 200)))
    assert table_state(spark, path).unique_keys == ("sku",)
    merge((5, 20), (6, 5), (7, 10), (300, 1))
    found = dict(rows(read_table(spark, path), "sku", "day"))
    assert found == {**{i: date(2026, 1, 10) for i in range(200)}, 5: date(2026, 1, 20), 300: date(2026, 1, 1)}
    # A plain write may bring a key twice: from then on all rows are ranked again.
    write_partitions(batch((5, 1), (5, 2)), path, ["shelf"])
    assert table_state(spark, path).unique_keys == ()
    merge((6, 1))
    assert rows(read_table(spark, path), "sku", "day") == [(5, date(2026, 1, 2)), (6, date(2026, 1, 1))]


def test_changes_are_recorded_by_partition(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge_partitions(shelf(spark, (1, "n", 5), (2, "s", 5)), path, ["shelf"], ["sku"], None)
    seen = table_state(spark, path).number
    assert changes_since(spark, path, seen) == set()
    merge_partitions(shelf(spark, (3, "s", 5), (4, None, 5)), path, ["shelf"], ["sku"], None)
    merge_partitions(shelf(spark, (5, "w", 5)), path, ["shelf"], ["sku"], None)
    assert changes_since(spark, path, seen) == {"s", None, "w"}
    monkeypatch.setattr(table_log, "KEPT_ENTRIES", 1)
    merge_partitions(shelf(spark, (5, "w", 6)), path, ["shelf"], ["sku"], None)
    assert changes_since(spark, path, 0) is None  # the first entries are gone
    now = table_state(spark, path).number
    write_table(shelf(spark, (1, "n", 5)), path, ["shelf"])
    assert changes_since(spark, path, now) is None  # a replacement may change anything


def test_missing_tables(spark, tmp_path):
    assert table_state(spark, str(tmp_path / "none")) is None
    with pytest.raises(MissingInputError):
        read_table(spark, str(tmp_path / "none"))
    empty = str(tmp_path / "empty")
    write_table(shelf(spark), empty)
    assert read_table(spark, empty).columns == ["sku", "shelf", "amount"] and read_table(spark, empty).count() == 0
