"""Parquet tables: replace, replace partitions, merge into partitions.

Rows are laid out with a ``rebalance`` hint on the partition columns: adaptive
execution merges small shuffle blocks and splits a partition that is larger
than the advisory size over several tasks, so neither many tiny files nor one
overloaded task come out, however unevenly the partitions are filled.

Every table keeps a log (see ``sources.table_log``). A replacing write goes to a
folder of its own, which becomes the table when it is complete: a write that
fails leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerwell.operators.dedup import keep_latest
from layerwell.operators.selection import semi, unmatched
from layerwell.session import scratch_path, table_scratch_path
from layerwell.sources.table_log import (
    Files,
    TableState,
    commit,
    listed_changes,
    next_folder,
    table_state,
    united_schema,
)
from layerwell.sources.tables import stored_rows

# Up to this many touched partitions are named in the filter on the existing
# table, which prunes directories at planning time. Beyond it a join finds them.
MAX_LISTED_PARTITIONS = 10_000

_ORIGIN = "__origin"


@dataclass(frozen=True)
class Draft:
    """Rows that are written, but not a table's yet."""

    path: str
    before: TableState | None
    folder: str
    schema: T.StructType

    def with_columns(self, schema: T.StructType) -> Draft:
        return replace(self, schema=united_schema(self.path, self.schema, schema))

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/{self.folder}")


def draft_table(df: DataFrame, path: str, partition_keys: Sequence[str] = ()) -> Draft:
    """Write what is to replace a table, beside it. ``df`` may read the table."""
    before = table_state(df.sparkSession, path)
    draft = Draft(path, before, next_folder(before), united_schema(path, None, df.schema))
    if partition_keys:
        df = df.hint("rebalance", *partition_keys)
    df.write.partitionBy(*partition_keys).parquet(f"{path}/{draft.folder}")
    return draft


def empty_draft(spark: SparkSession, path: str) -> Draft:
    """A draft to be filled in steps; its columns are those of what is added."""
    before = table_state(spark, path)
    return Draft(path, before, next_folder(before), T.StructType([]))


def add_to_draft(df: DataFrame, draft: Draft, partition_keys: Sequence[str]) -> None:
    """More rows, in the layout that ``df`` has, of partitions of their own."""
    df.write.mode("append").partitionBy(*partition_keys).parquet(f"{draft.path}/{draft.folder}")


def publish_draft(
    spark: SparkSession, draft: Draft, unique_keys: Sequence[str] = (), inputs: dict | None = None
) -> None:
    """Make a draft the table. ``unique_keys`` states a key that it is known to
    hold once, ``inputs`` what it was made from."""
    state = TableState(0, draft.folder, draft.schema, tuple(unique_keys), None, inputs)
    commit(spark, draft.path, draft.before, state)


def write_table(
    df: DataFrame, path: str, partition_keys: Sequence[str] = (), unique_keys: Sequence[str] = ()
) -> None:
    """Replace a table, which ``df`` may read from. Readers see the old rows until
    the new ones are complete; a failure on the way changes nothing."""
    publish_draft(df.sparkSession, draft_table(df, path, partition_keys), unique_keys)


def write_partitions(df: DataFrame, path: str, partition_keys: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; a null key is a
    partition of its own. No rows, no change."""
    overwrite_partitions(df.hint("rebalance", *partition_keys), path, partition_keys)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_keys: Sequence[str],
    unique_keys: Sequence[str] = (),
    changed: Sequence[str | None] | None = None,
) -> None:
    """As :func:`write_partitions`, in the layout that ``df`` has already.
    ``changed`` names the touched partitions, where the caller knows them."""
    spark = df.sparkSession
    before = table_state(spark, path) or adopted(spark, path)
    state = TableState(0, before.folder if before else "", df.schema, tuple(unique_keys))
    state = replace(state, schema=united_schema(path, before.schema if before else None, df.schema))
    if before is None or before.schema.names != state.schema.names or before.unique_keys != state.unique_keys:
        # Before the rows, so that no stored column is ever unknown and no key wrongly trusted.
        before = commit(spark, path, before, state)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_keys)
        .parquet(state.location(path))
    )
    commit(spark, path, before, replace(state, changed=None if changed is None else tuple(changed)))


def adopted(spark: SparkSession, path: str) -> TableState | None:
    """State of a table that was written without a log: its columns are read
    from its files, once."""
    if not Files(spark, path).there(path):
        return None
    try:
        found = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return TableState(0, "", united_schema(path, None, found.schema))


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    What follows reads columns from Parquet instead of repeating the work, also
    after an executor is lost, and sees the same rows every time.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The append-only table at ``path``, whose columns are fixed; empty if
    nothing has been appended yet."""
    if not Files(spark, path).there(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def merge_partitions(
    incoming: DataFrame,
    path: str,
    partition_keys: Sequence[str],
    primary_keys: Sequence[str],
    version: str | None,
    on_tie: str = "existing",
    incoming_order: Sequence[Column] = (),
    helper_columns: Sequence[str] = (),
    staged: bool = False,
    order_settles: bool = False,
) -> None:
    """Upsert ``incoming`` into the partitions it touches.

    Per touched partition the latest version of every key stays. On equal
    versions the existing row stays, or the incoming one with
    ``on_tie='incoming'``; among incoming rows ``incoming_order`` decides, all by
    itself if ``order_settles``. Without a version column ``on_tie`` alone
    decides. ``helper_columns`` serve the ordering and are not stored.

    Columns that only the table or only the batch has are kept, null where a row
    lacks them. Keys are compared within a partition: the same key may live in another one.
    Running the same merge again changes nothing.

    In a table that only merges have written, keys are unique. There only stored
    rows whose key comes in again are ranked; all others pass as they are.
    """
    if on_tie not in ("existing", "incoming"):
        raise ValueError(f"unknown on_tie: {on_tie}")
    spark = incoming.sparkSession
    batch = incoming
    if not staged:
        batch = stage(incoming, table_scratch_path(spark, path, "incoming"))
    touched = batch.select(*partition_keys).distinct()
    listed = touched.limit(MAX_LISTED_PARTITIONS + 1).collect()
    if partition_keys and not listed:
        return

    state = table_state(spark, path) or adopted(spark, path)
    schema = united_schema(path, state.schema if state else None, batch.drop(*helper_columns).schema)
    unique = state is None or state.unique_keys == tuple(primary_keys)
    existing = stored_rows(spark, path, replace(state, schema=schema)) if state else None
    if existing is not None and partition_keys:
        if len(listed) <= MAX_LISTED_PARTITIONS:
            existing = existing.where(_any_of(listed, partition_keys))
            touched = F.broadcast(touched)
        if len(listed) > MAX_LISTED_PARTITIONS or len(partition_keys) > 1:
            existing = semi(existing, touched, partition_keys)

    def latest(old: DataFrame | None) -> DataFrame:
        return _latest(old, batch, partition_keys, primary_keys, version, on_tie, incoming_order, order_settles)

    if existing is None or not unique:
        merged = latest(existing)
    else:
        keys = [*primary_keys, *partition_keys]
        incoming_keys = batch.select(*keys).distinct()
        merged = unmatched(existing, incoming_keys, keys).unionByName(
            latest(semi(existing, incoming_keys, keys)), allowMissingColumns=True
        )
    merged = _with_columns(merged, schema)
    if not partition_keys:
        write_table(merged, path, unique_keys=primary_keys)
        return
    changed = listed_changes([row[0] for row in listed]) if len(listed) <= MAX_LISTED_PARTITIONS else None
    overwrite_partitions(
        merged.hint("rebalance", *partition_keys), path, partition_keys,
        primary_keys if unique else (), changed,
    )


def _with_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, null where ``df`` lacks them."""
    return df.select(*(
        F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ))


def _latest(
    existing: DataFrame | None,
    batch: DataFrame,
    partition_keys: Sequence[str],
    primary_keys: Sequence[str],
    version: str | None,
    on_tie: str,
    incoming_order: Sequence[Column],
    order_settles: bool,
) -> DataFrame:
    both = batch.withColumn(_ORIGIN, F.lit(1))
    if existing is not None:
        both = existing.withColumn(_ORIGIN, F.lit(0)).unionByName(both, allowMissingColumns=True)
    origin = F.col(_ORIGIN).asc() if on_tie == "existing" else F.col(_ORIGIN).desc()
    if not version or version not in both.columns:
        # Nothing tells old from new: rank by origin alone.
        version, both = "__version", both.withColumn("__version", F.lit(None).cast("timestamp"))
    return keep_latest(
        both, primary_keys, version, scope=partition_keys,
        tie_breakers=[origin, *incoming_order], ties_settled=order_settles,
    )


def _any_of(rows: Sequence, keys: Sequence[str]) -> Column:
    """Filter on bare partition columns, so that it prunes directories."""
    condition = F.lit(True)
    for position, key in enumerate(keys):
        values = {row[position] for row in rows}
        column = F.col(f"`{key}`")
        wanted = column.isin(sorted(v for v in values if v is not None))
        condition = condition & ((wanted | column.isNull()) if None in values else wanted)
    return condition


def partition_names(df: DataFrame, partition_keys: Sequence[str]) -> DataFrame:
    """``key=value/...`` of every partition in ``df``, one row each."""
    parts = [
        F.concat(F.lit(f"{key}="), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null")))
        for key in partition_keys
    ]
    return df.select(*partition_keys).distinct().select(F.concat_ws("/", *parts).alias("partition"))


__all__ = [
    "MAX_LISTED_PARTITIONS",
    "Draft",
    "add_to_draft",
    "adopted",
    "draft_table",
    "empty_draft",
    "ensure_table",
    "merge_partitions",
    "overwrite_partitions",
    "partition_names",
    "publish_draft",
    "stage",
    "write_partitions",
    "write_table",
]
