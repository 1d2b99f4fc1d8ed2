"""The three layer transformations, as plain DataFrame functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from layerwell.operators.dedup import keep_latest, null_key_rows
from layerwell.operators.lineage import (
    BRONZE_INGESTED_AT,
    BRONZE_RUN_ID,
    SOURCE_FILE,
    SOURCE_KEY,
    SOURCE_POSITION,
    add_bronze_lineage,
    add_silver_lineage,
)
from layerwell.operators.quality import (
    enforce_schema_checks,
    primary_keys_exist,
    required_columns,
)
from layerwell.operators.schema import enforce_schema, lost_cells, rename_columns
from layerwell.functions.text import normalize_strings
from layerwell.plans.registry import GoldBuilder, SilverTransform
from layerwell.sources.delimited import BAD_LINE
from layerwell.sources.listing import source_key
from layerwell.sources.tabular import read_files
from layerwell.spec import SourceSpec, TableSpec

# Columns a silver batch carries for ordering but does not store.
BATCH_HELPERS = (SOURCE_FILE, SOURCE_POSITION)

# What a silver batch observes: rows without a key, and per column, behind this
# prefix, cells that hold something but do not fit the declared type.
NULL_KEYS, LOST_CELLS = "null_keys", "lost_cells:"


def bronze_frame(
    spark: SparkSession,
    paths: Sequence[str],
    source: SourceSpec,
    spec: TableSpec,
    run_id: str,
    ingested_at: datetime,
) -> DataFrame:
    """Landing files with lineage, all of them in one plan."""
    return with_bronze_lineage(
        read_files(spark, paths, source), source.name, spec, run_id, ingested_at
    )


def with_bronze_lineage(
    rows: DataFrame, name: str, spec: TableSpec, run_id: str, ingested_at: datetime
) -> DataFrame:
    enforce_schema_checks(required_columns(rows, spec.required_columns))
    return add_bronze_lineage(rows, name, F.col(SOURCE_FILE), run_id, ingested_at).withColumn(
        SOURCE_KEY, source_key(F.col(SOURCE_FILE))
    )


def silver_frame(
    bronze: DataFrame,
    spec: TableSpec,
    transform: SilverTransform,
    run_id: str,
    ingested_at: datetime,
    across_files: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Rename, transform, trim, keep the latest per key, enforce the schema.

    The latest row is chosen within each file, where all rows share one
    ingestion time, so the first one stays. ``across_files`` chooses over all
    files instead, which makes the choice within files redundant. Rows without
    a key disappear here; ``observation`` reports their number, and that of the
    cells of each column, in all rows, that the declared type turns into null.
    Lines that bronze keeps as bad ones have no values and stay behind.
    """
    if BAD_LINE in bronze.columns:
        bronze = bronze.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    df = bronze.transform(rename_columns, spec).transform(transform)
    df = normalize_strings(df)
    enforce_schema_checks(primary_keys_exist(df, spec.primary_keys))
    kept = (BRONZE_INGESTED_AT, BRONZE_RUN_ID, *BATCH_HELPERS)
    df = df.select(*(c for c in df.columns if c in (*spec.column_names, *kept)))
    if observation is not None:
        lost = lost_cells(df, spec.dtypes, spec.formats)
        df = df.observe(
            observation,
            null_key_rows(df, spec.primary_keys).alias(NULL_KEYS),
            *(F.count_if(cells).alias(f"{LOST_CELLS}{name}") for name, cells in lost.items()),
        )
    order = [F.col(c) for c in BATCH_HELPERS if c in df.columns]
    df = keep_latest(
        df,
        spec.primary_keys,
        BRONZE_INGESTED_AT,
        [] if across_files else [c for c in (SOURCE_FILE,) if c in df.columns],
        order,
        # File and position identify a row, so no other column need decide.
        ties_settled=len(order) == len(BATCH_HELPERS),
    )
    df = enforce_schema(df, spec.dtypes, keep=kept, formats=spec.formats)
    return add_silver_lineage(df, run_id, ingested_at)


def keys_proved_unique(bronze: DataFrame, spec: TableSpec, transform: SilverTransform) -> bool:
    """True when the cast leaves the keys as they were de-duplicated: then the
    batch cannot hold duplicates and need not be aggregated to find out."""
    before = normalize_strings(bronze.transform(rename_columns, spec).transform(transform))
    if BRONZE_INGESTED_AT not in before.columns:
        return False
    types = {f.name: f.dataType for f in before.schema.fields}
    declared = {f.name: f.dataType for f in spec.struct_type().fields}
    return all(types.get(key) == declared[key] for key in spec.primary_keys)


def gold_frame(inputs: Mapping[str, DataFrame], spec: TableSpec, builder: GoldBuilder) -> DataFrame:
    """Build a gold table and enforce its declared schema."""
    return enforce_schema(builder(inputs), spec.dtypes)
