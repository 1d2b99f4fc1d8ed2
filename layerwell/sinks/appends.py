"""Tables that only grow, by many small appends: manifests, audit records.

Every append is a folder of its own, named by the table's log once it is
complete, so a failed append leaves nothing that readers see. Once in
``FOLD_AFTER`` changes the newest folders are folded into one. An older folder
takes part only while those after it have reached half its size, so a row is
rewritten a number of times that grows with the logarithm of the table, and the
number of folders stays bounded the same way.

Several runs may append at once: the loser of a race puts its folder on top of
the winner's entry. A fold that loses is left to a later append.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, types as T

from layerwell.errors import DataQualityError, WriteConflict
from layerwell.sinks.parquet import adopted
from layerwell.sources.table_log import (
    Files,
    TableState,
    next_folder,
    record,
    table_state,
    united_schema,
)
from layerwell.sources.tables import stored_rows

FOLD_AFTER = 20
# Entries of the log that are kept; nobody derives tables from these changes.
KEPT = 20
TRIES = 20


def appended_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows appended so far, by columns that are fixed. They can be read until
    the table has been folded twice from now on."""
    state = table_state(spark, path) or adopted(spark, path)
    if state is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*state.locations(path))


def append_rows(df: DataFrame, path: str, fold_after: int = FOLD_AFTER) -> None:
    """Add rows, also such as stem from the table itself. A column that the table
    lacks is null in the rows before; one that changes its type is an error. So
    is a table whose partitions are overwritten, which has rows beside its log."""
    spark, files = df.sparkSession, Files(df.sparkSession, path)
    before = table_state(spark, path)
    if before and not before.folder:
        raise DataQualityError(f"{path} is a table of partitions; merge into it")
    if before is None and (loose := adopted(spark, path)):
        # Files without a log lie in the table's own folder: they move into one.
        df = stored_rows(spark, path, loose).unionByName(df, allowMissingColumns=True)
    united_schema(path, before.schema if before else None, df.schema)
    folder = next_folder(before)
    df.write.parquet(f"{path}/{folder}")
    for left in reversed(range(TRIES)):
        try:
            state = record(files, path, before, _with_folder(path, before, folder, df.schema), KEPT)
            break
        except WriteConflict:
            if not left:
                raise
            before = table_state(spark, path)
    if state.number % fold_after == 0:
        fold(spark, path, fold_after)


def fold(spark: SparkSession, path: str, fold_after: int = FOLD_AFTER) -> bool:
    """Write the newest folders as one. The folders replaced are deleted by the
    next fold; readers that have begun can finish. False if another run was
    faster."""
    files, before = Files(spark, path), table_state(spark, path)
    folders = [before.folder, *before.appended]
    first = _first_to_fold([files.size(f"{path}/{f}") for f in folders], fold_after)
    stay, go = folders[:first], folders[first:]
    made = next_folder(before)
    rows = spark.read.schema(before.schema).parquet(*(f"{path}/{f}" for f in go))
    rows.hint("rebalance").write.parquet(f"{path}/{made}")
    base, *appended = [*stay, made]
    after = replace(before, folder=base, appended=tuple(appended), retired=tuple(go))
    try:
        record(files, path, before, after, KEPT)
    except WriteConflict:
        files.delete(f"{path}/{made}")
        return False
    for folder in before.retired:
        files.delete(f"{path}/{folder}")
    return True


def _with_folder(path: str, before: TableState | None, folder: str, schema: T.StructType) -> TableState:
    if before is None:
        return TableState(0, folder, united_schema(path, None, schema))
    schema = united_schema(path, before.schema, schema)
    appended = (*before.appended, folder)
    return replace(before, schema=schema, appended=appended, unique_keys=(), changed=None)


def _first_to_fold(sizes: Sequence[int], fold_after: int) -> int:
    """Position of the oldest folder that takes part."""
    first, later, always = len(sizes), 0, max(2, fold_after // 2)
    while first and (len(sizes) - first < always or sizes[first - 1] <= 2 * later):
        first -= 1
        later += sizes[first]
    return first
