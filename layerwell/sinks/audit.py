"""One record per run, layer and table, and one row per file it touched."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from layerwell.sinks.appends import append_rows

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("code_version", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("log_file", T.StringType()),
        T.StructField("num_processed_input_files", T.LongType()),
        T.StructField("num_processed_output_files", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("configs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)

FILE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)


@dataclass(frozen=True)
class RunRecord:
    run_id: str
    layer: str
    table: str
    start_time: datetime
    end_time: datetime | None = None
    inputs: int = 0
    outputs: int = 0
    rows_written: int | None = None
    code_version: str | None = None
    log_file: str | None = None
    configs: Mapping[str, Any] = field(default_factory=dict)

    def row(self) -> dict[str, Any]:
        """End time defaults to now and inherits the zone of the start time."""
        zone = self.start_time.tzinfo
        if zone is None:
            raise ValueError("start_time must carry a time zone")
        end = self.end_time or datetime.now(zone)
        if end.tzinfo is None:
            end = end.replace(tzinfo=zone)
        return {
            "run_id": self.run_id,
            "code_version": self.code_version,
            "layer": self.layer,
            "table": self.table,
            "log_file": self.log_file,
            "num_processed_input_files": self.inputs,
            "num_processed_output_files": self.outputs,
            "rows_written": self.rows_written,
            "configs": {k: json.dumps(v, default=str) for k, v in self.configs.items()},
            "start_time": self.start_time.astimezone(timezone.utc),
            "end_time": end.astimezone(timezone.utc),
            "duration_seconds": (end - self.start_time).total_seconds(),
        }


def run_table(spark: SparkSession, *records: RunRecord) -> DataFrame:
    return spark.createDataFrame([r.row() for r in records], RUN_SCHEMA)


def file_table(files: DataFrame, run_id: str, layer: str, table: str, role: str) -> DataFrame:
    """Audit rows for a one-column DataFrame of paths."""
    (path,) = files.columns
    return files.select(
        F.lit(run_id).alias("run_id"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table"),
        F.lit(role).alias("role"),
        F.col(path).alias("path"),
    )


def append_runs(spark: SparkSession, path: str, *records: RunRecord) -> None:
    append_rows(run_table(spark, *records).coalesce(1), f"{path}/runs")


def append_files(files: DataFrame, path: str) -> None:
    append_rows(files, f"{path}/files")
