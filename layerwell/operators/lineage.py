"""Columns that say where a row came from and which run wrote it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

# Lineage column names.
BRONZE_INGESTED_AT = "_bronze_ingested_at"
SOURCE_NAME = "_source_name"
SOURCE_FILE = "_source_file"
BRONZE_RUN_ID = "_bronze_run_id"
SILVER_INGESTED_AT = "_silver_ingested_at"
SILVER_RUN_ID = "_silver_run_id"

# Ours: position of a row inside its file, so that "first in the file" stays
# answerable after Spark has distributed the rows.
SOURCE_POSITION = "_source_position"
# Ours: file name up to its first dot, the bronze partition column.
SOURCE_KEY = "_source_key"

BRONZE_LINEAGE = (BRONZE_INGESTED_AT, SOURCE_NAME, SOURCE_FILE, BRONZE_RUN_ID)
SILVER_LINEAGE = (SILVER_INGESTED_AT, SILVER_RUN_ID, BRONZE_INGESTED_AT, BRONZE_RUN_ID)


def add_bronze_lineage(
    df: DataFrame,
    source_name: str,
    source_file: str | Column,
    run_id: str,
    ingested_at: datetime,
) -> DataFrame:
    """``source_file`` is a column when many files are read at once."""
    file = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return df.withColumns(
        {
            BRONZE_INGESTED_AT: F.lit(ingested_at),
            SOURCE_NAME: F.lit(source_name),
            SOURCE_FILE: file,
            BRONZE_RUN_ID: F.lit(run_id),
        }
    )


def add_silver_lineage(df: DataFrame, run_id: str, ingested_at: datetime) -> DataFrame:
    """Bronze lineage is carried per row; where it is absent it becomes null."""
    added = {
        SILVER_INGESTED_AT: F.lit(ingested_at),
        SILVER_RUN_ID: F.lit(run_id),
    }
    if BRONZE_INGESTED_AT not in df.columns:
        added[BRONZE_INGESTED_AT] = F.lit(None).cast("timestamp")
    if BRONZE_RUN_ID not in df.columns:
        added[BRONZE_RUN_ID] = F.lit(None).cast("string")
    return df.withColumns(added)
