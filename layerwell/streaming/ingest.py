"""Incremental ingestion and upsert as streaming queries.

The file source remembers which files it has handed out, so each file is used
exactly once; ``availableNow`` works off what is there and stops. Batches that
are delivered again after a failure change nothing: bronze replaces the
partitions of the files in the batch, silver merges by key. A late file needs
no watermark, as it rewrites just the partitions its rows belong to.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from layerwell.errors import ConfigError
from layerwell.operators.lineage import SOURCE_FILE, SOURCE_KEY, SOURCE_POSITION
from layerwell.plans.layers import with_bronze_lineage
from layerwell.plans.refresh import FILE_SCHEMA, Run, merge_bronze_batch, write_bronze
from layerwell.sinks.parquet import merge_partitions
from layerwell.sources.delimited import (
    csv_options,
    judged,
    kept_lines,
    nulls_for_blanks,
    parse_zipped_delimited,
    text_schema,
)
from layerwell.sources.listing import key_collisions, own_file_name, own_file_path, source_key
from layerwell.sources.manifest import load_manifest, record_files
from layerwell.sources.table_log import table_state
from layerwell.spec import SourceSpec

FILE = "__file"

# Fixed: what Spark reads of whole files.
ARCHIVE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_upsert(
    stream: DataFrame,
    path: str,
    partition_keys: Sequence[str],
    primary_keys: Sequence[str],
    version: str | None,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    on_tie: str = "existing",
    staged: bool = False,
) -> StreamingQuery:
    """Merge every micro-batch into a partitioned table, then stop. ``staged``
    states that a batch is files of rows as they are to be merged, which may be
    read again; else its rows are written once before they are ranked."""

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_partitions(
            transform(batch), path, partition_keys, primary_keys, version, on_tie=on_tie, staged=staged
        )

    return run_available(stream.writeStream.foreachBatch(merge), checkpoint)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Start a query over everything that is available and wait for its end."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_delimited(
    spark: SparkSession, folder: str, source: SourceSpec, files_per_batch: int = 1_000
) -> DataFrame:
    """Text files of a folder as a stream, one bounded batch of files at a time."""
    names = source.reader.get("names")
    if source.file_type != "csv" or source.compression == "zip" or not names:
        raise ConfigError(f"source {source.name}: only named text columns can be streamed")
    rows = (
        spark.readStream.schema(text_schema(names))
        .options(**csv_options(source.reader))
        .option("header", source.reader.get("header") is not None)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return judged(rows, names, source.reader).select(
        *nulls_for_blanks(names, source.reader),
        *kept_lines(source.reader),
        own_file_name().alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias("__block"),
        F.struct(
            own_file_path().alias("path"),
            source_key(own_file_name()).alias("source_key"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        ).alias(FILE),
    )


def stream_archives(
    spark: SparkSession, folder: str, source: SourceSpec, files_per_batch: int = 1_000
) -> DataFrame:
    """Zip archives of a folder as a stream of whole files, to be parsed batch by
    batch, as a text that names no columns cannot be."""
    if source.file_type != "csv" or not source.reader.get("names"):
        raise ConfigError(f"source {source.name}: only named text columns can be streamed")
    return (
        spark.readStream.format("binaryFile").schema(ARCHIVE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def stream_bronze(run: Run, table: str, checkpoint: str) -> StreamingQuery:
    """Landing files into the bronze table, each file once: text, or zip archives
    of text. The files are also recorded in the manifest, so that silver may be
    refreshed either way."""
    source, spec = run.config.source(table), run.config.bronze[table]
    zipped = source.compression == "zip"
    landing, manifest = run.lake.landing(table), run.lake.manifest("bronze", table)
    stream = (stream_archives if zipped else stream_delimited)(run.spark, landing, source)

    def write(batch: DataFrame, _batch_id: int) -> None:
        if zipped:
            named = source_key(F.substring_index("path", "/", -1)).alias("source_key")
            batch = batch.withColumn(FILE, F.struct("path", named, F.col("modificationTime").alias("modified_at")))
        _refuse_shared_keys(batch, load_manifest(run.spark, manifest))
        # A batch holds a bounded number of files, so their set is small.
        if zipped:
            found = [tuple(file) for file in batch.select(f"{FILE}.*").collect()]
            rows = parse_zipped_delimited(batch.select("path", "content"), source.reader)
        else:
            files = Observation()
            rows = _with_positions(batch).observe(files, F.collect_set(FILE).alias("files")).drop(FILE)
        write_bronze(
            with_bronze_lineage(rows, source.name, spec, run.run_id, run.now),
            run.lake.bronze(table),
        )
        if not zipped:
            found = [tuple(file) for file in files.get["files"]]
        record_files(run.spark.createDataFrame(found, FILE_SCHEMA), manifest, run.run_id, run.now)

    return run_available(stream.writeStream.foreachBatch(write), checkpoint)


def _with_positions(batch: DataFrame) -> DataFrame:
    position = F.struct(
        F.col("__block").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return batch.withColumn(SOURCE_POSITION, position).drop("__block")


def _refuse_shared_keys(batch: DataFrame, known: DataFrame) -> None:
    """A key names a bronze partition: a second file with it would replace the
    rows of the first, in this batch or in an earlier one."""
    files = batch.select(f"{FILE}.path", f"{FILE}.source_key").distinct()
    clash = key_collisions(files.unionByName(known.select("path", "source_key"))).join(
        files.select("source_key"), "source_key", "left_semi"
    ).first()
    if clash:
        raise ConfigError(f"several landing files share the key {clash['source_key']!r}")


def stream_silver(
    run: Run,
    table: str,
    schema: T.StructType,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bronze rows into the silver table; ``schema`` is that of the bronze table.

    By default one batch takes all that is new, so that rows of one source file
    are judged together. A limit bounds the batches of a large backlog.
    """
    reader = run.spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_bronze_batch(run, table, batch.drop(SOURCE_KEY))

    bronze = run.lake.bronze(table)
    state = table_state(run.spark, bronze)
    stream = reader.parquet(state.location(bronze) if state else bronze)
    return run_available(stream.writeStream.foreachBatch(merge), checkpoint)
