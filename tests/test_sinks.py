"""Parquet tables, audit records and database publishing."""

import json
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter, functions as F

from layerwell.sinks.audit import RunRecord, append_runs, file_table, run_table
from layerwell.sinks.jdbc import publish_table
from layerwell.sinks.parquet import (
    ensure_table,
    merge_partitions,
    partition_names,
    stage,
    write_partitions,
    write_table,
)
from layerwell.sources.tables import partition_folder, read_partition, read_partitions, read_snapshot, read_table, read_window
from layerwell.errors import DataQualityError, MissingInputError

SCHEMA = "id long, day string, value long, version timestamp"
T1, T2 = datetime(2026, 2, 15), datetime(2026, 2, 16, 12)


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=str)


def partitions(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir() and p.name[0] not in "._")


def test_round_trip_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, 20)], "id long, value long")
    write_table(df, path)
    assert rows(read_table(spark, path)) == [(1, 10), (2, 20)]
    write_table(df.where("id = 2"), path)
    assert rows(read_table(spark, path)) == [(2, 20)]
    assert rows(read_table(spark, path, ["value"], F.col("id") > 1)) == [(20,)]
    with pytest.raises(MissingInputError):
        read_table(spark, str(tmp_path / "absent"))


def test_partitioned_write(spark, tmp_path):
    df = spark.createDataFrame(
        [("eu", 7, 1.5), ("us", 7, 2.5), ("eu", 11, 3.5), ("eu", 7, 4.5)], "zone string, week long, price double"
    )
    write_partitions(df, str(tmp_path / "t"), ["zone", "week"])
    found = sorted(str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("*/*") if p.is_dir())
    assert found == ["zone=eu/week=11", "zone=eu/week=7", "zone=us/week=7"]
    assert rows(partition_names(df, ["zone", "week"])) == [(f,) for f in found]


def test_only_written_partitions_are_replaced(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, day string")
    write_partitions(df, str(path), ["day"])
    assert partitions(path) == ["day=__HIVE_DEFAULT_PARTITION__", "day=a", "day=b"]
    write_partitions(spark.createDataFrame([(9, "b")], "id long, day string"), str(path), ["day"])
    assert rows(read_table(spark, str(path))) == [(1, "a"), (3, None), (9, "b")]
    write_partitions(df.where("id < 0"), str(path), ["day"])
    assert rows(read_table(spark, str(path))) == [(1, "a"), (3, None), (9, "b")]


def test_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(
        spark.createDataFrame([(1, "a", 10, T1), (2, "a", 20, T1), (7, "z", 70, T1)], SCHEMA), path, ["day"]
    )
    incoming = spark.createDataFrame([(2, "a", 21, T2), (3, "a", 30, T2), (4, "b", 40, T2)], SCHEMA)
    expected = [(1, "a", 10, T1), (2, "a", 21, T2), (3, "a", 30, T2), (4, "b", 40, T2), (7, "z", 70, T1)]
    for _ in range(2):
        merge_partitions(incoming, path, ["day"], ["id"], "version")
        assert rows(read_table(spark, path), "id", "day", "value", "version") == expected


@pytest.mark.parametrize("on_tie, winner", [("existing", 1), ("incoming", 2)])
@pytest.mark.parametrize("version", ["version", None])
def test_merge_ties(spark, tmp_path, on_tie, winner, version):
    path = str(tmp_path / "t")
    for value in (1, 2):
        df = spark.createDataFrame([(1, "a", value, T1)], SCHEMA)
        merge_partitions(df, path, ["day"], ["id"], version, on_tie=on_tie)
    assert rows(read_table(spark, path), "value") == [(winner,)]


def test_merge_is_local_to_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in ("a", "b"):
        merge_partitions(spark.createDataFrame([(1, day, 1, T1)], SCHEMA), path, ["day"], ["id"], "version")
    assert rows(read_table(spark, path), "id", "day") == [(1, "a"), (1, "b")]


def test_merge_null_partition_and_two_partition_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id long, y long, m long, value long, version timestamp"
    first = [(1, 2026, 1, 1, T1), (2, 2026, None, 2, T1), (3, 2025, 1, 3, T1), (4, 2025, 2, 4, T1)]
    merge_partitions(spark.createDataFrame(first, schema), path, ["y", "m"], ["id"], "version")
    second = [(1, 2026, 1, 9, T2), (2, 2026, None, 8, T2), (5, 2025, 2, 5, T2)]
    merge_partitions(spark.createDataFrame(second, schema), path, ["y", "m"], ["id"], "version")
    assert rows(read_table(spark, path), "id", "y", "m", "value") == sorted(
        [(1, 2026, 1, 9), (2, 2026, None, 8), (3, 2025, 1, 3), (4, 2025, 2, 4), (5, 2025, 2, 5)], key=str
    )


def test_merge_beyond_the_listed_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("layerwell.sinks.parquet.MAX_LISTED_PARTITIONS", 1)
    path = str(tmp_path / "t")
    first = [(1, "a", 1, T1), (2, "b", 2, T1), (3, "c", 3, T1)]
    merge_partitions(spark.createDataFrame(first, SCHEMA), path, ["day"], ["id"], "version")
    second = [(1, "a", 9, T2), (2, "b", 8, T2)]
    merge_partitions(spark.createDataFrame(second, SCHEMA), path, ["day"], ["id"], "version")
    assert rows(read_table(spark, path), "id", "value") == [(1, 9), (2, 8), (3, 3)]


def test_merge_unpartitioned_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_partitions(spark.createDataFrame([(1, "a", 1, T1)], SCHEMA), path, [], ["id"], "version")
    merge_partitions(spark.createDataFrame([(1, "a", 2, T2), (2, "b", 3, T2)], SCHEMA), path, [], ["id"], "version")
    assert rows(read_table(spark, path), "id", "value") == [(1, 2), (2, 3)]
    merge_partitions(spark.createDataFrame([], SCHEMA), str(tmp_path / "n"), ["day"], ["id"], "version")
    assert not (tmp_path / "n").exists()


def test_random_merges_match_a_model(spark, tmp_path):
    rng, path, model = random.Random(3), str(tmp_path / "t"), {}
    for _ in range(3):
        batch = [
            (rng.randrange(15), rng.choice("abc"), rng.randrange(9), T1 + timedelta(days=rng.randrange(4)))
            for _ in range(60)
        ]
        best = {}
        for row in sorted(batch, key=lambda r: (-r[3].toordinal(), r[2])):
            best.setdefault((row[1], row[0]), row)
        for key, row in best.items():
            if key not in model or row[3] > model[key][3]:
                model[key] = row
        df = spark.createDataFrame(batch, SCHEMA).repartition(4)
        merge_partitions(df, path, ["day"], ["id"], "version")
        assert rows(read_table(spark, path), "id", "day", "value", "version") == sorted(model.values(), key=str)


def test_hot_partition_is_split_over_several_files(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(400_000).select("id", F.lit("hot").alias("day"), F.rand(1).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_partitions(df, str(path), ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((path / "day=hot").glob("*.parquet"))) > 1
    assert read_table(spark, str(path)).count() == 400_000


def test_partition_read(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], "id long, day string").schema
    empty, files = read_partition(spark, path, schema, {"day": "a"})
    assert (empty.columns, empty.count(), files.count()) == (["id", "day"], 0, 0)
    for value in (1, 2):
        spark.createDataFrame([(value, "a"), (value, "b")], schema).coalesce(1).write.mode(
            "append"
        ).partitionBy("day").parquet(path)
    found, files = read_partition(spark, path, schema, {"day": "a"})
    assert rows(found) == [(1, "a"), (2, "a")] and files.count() == 2
    none, files = read_partition(spark, path, schema, {"day": "c"})
    assert (none.count(), files.count()) == (0, 0)


def test_partitions_by_name(spark, tmp_path):
    names = ["plain", "a b", "x=1/y:z", 'q"#%?*{[]}^', "é+ü"]
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "k string, v long")
    write_partitions(df, path, ["k"])
    assert {partition_folder("k", n) for n in names} == set(partitions(tmp_path / "t"))
    assert rows(read_partitions(spark, path, "k", names[1:4]), "v") == [(1,), (2,), (3,)]
    assert rows(read_partitions(spark, path, "k", ["absent", "plain"]), "v") == [(0,)]


def test_window_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select(
        "id", F.date_add(F.lit(date(2026, 1, 1)), F.col("id").cast("int")).alias("day")
    )
    write_partitions(df, path, ["day"])
    window = read_window(spark, path, "day", date(2026, 1, 3), date(2026, 1, 5))
    assert rows(window, "id") == [(2,), (3,), (4,)]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_snapshot_must_be_single(spark, tmp_path):
    path, days = str(tmp_path / "t"), (date(2026, 1, 1), date(2026, 2, 1))
    df = spark.createDataFrame(
        [("s1", datetime(2026, 1, 15)), ("s1", datetime(2026, 3, 1)), ("s1", None)],
        "snapshot string, at timestamp",
    )
    write_table(df, path)
    assert read_snapshot(spark, path, "snapshot", "at", *days).count() == 1
    write_table(df.union(df.withColumn("snapshot", F.lit("s2"))), path)
    with pytest.raises(DataQualityError):
        read_snapshot(spark, path, "snapshot", "at", *days)


def test_ensure_table_and_stage(spark, tmp_path):
    schema = spark.createDataFrame([], "a long, p string").schema
    assert ensure_table(spark, str(tmp_path / "t"), schema).count() == 0
    df = spark.createDataFrame([(1, "x")], schema)
    df.write.mode("append").parquet(str(tmp_path / "t"))
    assert rows(ensure_table(spark, str(tmp_path / "t"), schema)) == [(1, "x")]
    staged = stage(df.withColumn("r", F.rand()))
    assert staged.collect() == staged.collect()


# ------------------------------------------------------------------------ audit

START = datetime(2026, 2, 16, 10, tzinfo=timezone.utc)


def test_run_record(spark, tmp_path):
    record = RunRecord(
        "run1", "bronze", "feed", START, START + timedelta(seconds=60),
        inputs=2, outputs=1, rows_written=5, code_version="abc", configs={"pipeline": {"name": "p"}},
    )
    append_runs(spark, str(tmp_path), record)
    append_runs(spark, str(tmp_path), record)
    stored = read_table(spark, f"{tmp_path}/runs").collect()
    assert len(stored) == 2
    row = stored[0]
    assert (row["num_processed_input_files"], row["num_processed_output_files"]) == (2, 1)
    assert (row["duration_seconds"], row["rows_written"], row["code_version"]) == (60.0, 5, "abc")
    assert json.loads(row["configs"]["pipeline"]) == {"name": "p"}


def test_run_record_times(spark):
    with pytest.raises(ValueError):
        RunRecord("r", "l", "t", datetime(2026, 1, 1)).row()
    assert RunRecord("r", "l", "t", START).row()["duration_seconds"] > 0
    naive_end = RunRecord("r", "l", "t", START, datetime(2026, 2, 16, 10, 1)).row()
    assert naive_end["duration_seconds"] == 60.0
    assert run_table(spark, RunRecord("r", "l", "t", START)).count() == 1


def test_file_rows(spark):
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    assert rows(file_table(files, "r", "silver", "t", "input")) == [
        ("r", "silver", "t", "input", "a"), ("r", "silver", "t", "input", "b")
    ]


# -------------------------------------------------------------------- publishing


def test_publish_replaces_and_verifies(spark, tmp_path, monkeypatch):
    """The database is stood in for by Parquet; one run is still to be made
    against a real one."""
    calls = []

    def write(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties))
        df = self._df if len(calls) > 1 else self._df.union(self._df)
        df.write.mode("overwrite").parquet(f"{tmp_path}/{table}")

    def read(self, url, table, properties=None, **_):
        return spark.read.parquet(f"{tmp_path}/{table}")

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    df = spark.range(5).toDF("id")
    # The first attempt stores every row twice and is repeated.
    assert publish_table(df, "jdbc:x", "report", {"user": "u"}) == 5
    assert len(calls) == 2 and calls[0][2] == {"user": "u", "batchsize": "10000"}
    calls.clear()
    with pytest.raises(RuntimeError):
        publish_table(df, "jdbc:x", "report", attempts=1)
