"""Streaming ingestion and upsert: exactly once, idempotent, late data."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from layerwell.errors import ConfigError
from layerwell.plans import queries
from layerwell.plans.queries import BUILDERS, LAYERED_CONFIG, TRANSFORMS
from layerwell.plans.refresh import Lake, Run
from layerwell.sinks import parquet
from layerwell.sources.listing import list_files
from layerwell.sources.tables import read_table
from layerwell.spec import SourceSpec
from layerwell.streaming.ingest import stream_bronze, stream_delimited, stream_silver, stream_upsert

SCHEMA = "id long, day string, value long, version timestamp"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_upsert_takes_each_file_once(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")

    def deliver(*data):
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(landing)

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        query = stream_upsert(stream, table, ["day"], ["id"], "version", str(tmp_path / "cp"))
        return sum(p["numInputRows"] for p in query.recentProgress)

    t1, t2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    deliver((1, "a", 1, t1), (2, "b", 2, t1))
    assert run() == 2
    assert run() == 0
    deliver((1, "a", 9, t2), (3, "a", 3, t1))
    assert run() == 2
    assert rows(read_table(spark, table), "id", "day", "value") == [(1, "a", 9), (2, "b", 2), (3, "a", 3)]


def test_batch_delivered_twice_changes_nothing(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    data = [(1, "a", 1, datetime(2026, 1, 1))]
    spark.createDataFrame(data, SCHEMA).write.parquet(landing)
    for checkpoint in ("cp1", "cp2"):
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        stream_upsert(stream, table, ["day"], ["id"], "version", str(tmp_path / checkpoint))
        assert rows(read_table(spark, table), "id", "value") == [(1, 1)]


def test_stored_rows_are_not_written_twice(spark, tmp_path, monkeypatch):
    """Batches that are files of finished rows are ranked from there."""
    landing, written = str(tmp_path / "landing"), []
    monkeypatch.setattr(parquet, "stage", lambda df, path=None: written.append(path) or df)
    t1, t2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    for n, data in enumerate(([(1, "a", 1, t1), (1, "a", 2, t1), (2, None, 2, t1)], [(1, "a", 0, t2), (None, "a", 5, t2)])):
        spark.createDataFrame(data, SCHEMA).write.mode("append").parquet(landing)
        for staged in (True, False):
            stream = spark.readStream.schema(SCHEMA).parquet(landing)
            table, checkpoint = (str(tmp_path / f"{name}{staged}") for name in ("table", "cp"))
            stream_upsert(stream, table, ["day"], ["id"], "version", checkpoint, staged=staged)
            assert rows(read_table(spark, table), "id", "day", "value") == [(1, "a", 1 - n), (2, None, 2)]
        assert len(written) == n + 1  # by the one that is not staged


def test_append_incremental_does_every_step(spark, tmp_path, monkeypatch):
    """Each delivery is taken once as a whole, written before it is ranked, and merged."""
    data = [
        (1, 1, "A", "F", "2026-01-01", 1), (1, 1, "A", "O", "2026-01-01", 2), (1, 1, "N", "O", "2026-01-01", 3),
        (2, 1, "A", "F", "2026-01-01", 4), (2, 1, "A", "O", "2026-01-02", 5), (2, 1, "A", None, "2026-01-03", 6),
        (3, 1, None, "F", "2026-01-01", 7), (3, 1, None, "F", "2026-01-02", 8), (None, 1, "A", "F", "2026-01-01", 9),
    ]
    names = "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate string, l_quantity long"
    items = spark.createDataFrame(data, names).withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    written, read = [], []
    real_stage, real_upsert = parquet.stage, queries.stream_upsert

    def stage(df, path=None):
        out = real_stage(df, path)
        written.append(out.count())
        return out

    def upsert(*args, **options):
        query = real_upsert(*args, **options)
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        return query

    monkeypatch.setattr(parquet, "stage", stage)
    monkeypatch.setattr(queries, "stream_upsert", upsert)
    kept = queries.QUERIES["append_incremental"](spark, str(tmp_path))
    assert rows(kept, "l_orderkey", "l_returnflag", "l_quantity") == [(1, "A", 1), (1, "N", 3), (2, "A", 6), (3, None, 8)]
    assert written == [5, 4] and read == [5, 4, 0]


def test_layers_as_streams(spark, tmp_path):
    now = datetime(2024, 2, 1, tzinfo=timezone.utc)
    run = Run(spark, LAYERED_CONFIG, Lake(str(tmp_path)), TRANSFORMS, BUILDERS, "r1", now)
    landing = tmp_path / "landing" / "events"
    landing.mkdir(parents=True)
    checkpoints = str(tmp_path / "cp1"), str(tmp_path / "cp2")

    def advance():
        stream_bronze(run, "events", checkpoints[0])
        schema = read_table(spark, run.lake.bronze("events")).schema
        stream_silver(run, "events", schema, checkpoints[1])
        return rows(read_table(spark, run.lake.silver("events")), "event_id", "day", "event_type")

    (landing / "2.csv").write_text("20240102\t7\t30\tx\t150\t4\n20240102\t7\t30\ty\t150\t4\n")
    first = advance()
    assert [(i, str(d), a) for i, d, a in first] == [("7", "2024-01-02", "x")]
    # A late file for an earlier day, and another version of a known key.
    (landing / "1 a+b.csv").write_text("20240101\t8\t31\tlate\t25\t9\n20240102\t7\t30\tz\t150\t4\n")
    second = advance()
    assert [(i, str(d), a) for i, d, a in second] == [("7", "2024-01-02", "x"), ("8", "2024-01-01", "late")]
    assert advance() == second
    # The manifest knows the files under the paths that a listing gives.
    manifest, listing = run.manifest("bronze", "events"), list_files(spark, run.lake.landing("events"))
    assert rows(manifest, "path", "source_key", "modified_at") == rows(listing, "path", "source_key", "modified_at")
    bronze = read_table(spark, run.lake.bronze("events"))
    assert rows(bronze.groupBy("_source_file").agg(F.count("*").alias("n")), "_source_file", "n") == [("1 a+b.csv", 2), ("2.csv", 2)]


def test_only_named_text_is_streamed(spark, tmp_path):
    for spec in (
        SourceSpec("s", "append", file_type="xlsx"),
        SourceSpec("s", "append", compression="zip", reader={"names": ["a"]}),
        SourceSpec("s", "append", reader={"header": 0}),
    ):
        with pytest.raises(ConfigError):
            stream_delimited(spark, str(tmp_path), spec)
