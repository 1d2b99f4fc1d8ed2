"""Record of processed files, kept as an append-only table that folds itself."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from layerwell.operators.selection import anti
from layerwell.sinks.appends import append_rows, appended_rows

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("source_key", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Recorded files; none if nothing has been recorded yet."""
    return appended_rows(spark, path, MANIFEST_SCHEMA)


def record_files(
    files: DataFrame, path: str, run_id: str, processed_at: datetime, all_new: bool = False
) -> None:
    """Add files (``path, source_key, modified_at``) that are not recorded yet.
    Say ``all_new`` when they were chosen as such, which spares the comparison."""
    entries = files.select(
        "path",
        "source_key",
        "modified_at",
        F.lit(run_id).alias("run_id"),
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
    )
    if not all_new:
        entries = anti(entries, load_manifest(files.sparkSession, path), "path")
    append_rows(entries, path)
