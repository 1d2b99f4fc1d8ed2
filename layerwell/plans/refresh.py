"""Refreshing bronze, silver and gold tables, and publishing them.

Every refresh follows the same steps: find what is new, write the transformed
batch once to the shared scratch folder while its checks are observed, stop if
a critical check failed, then change the table. A table is never touched before
its new content exists and is known to be good, and running a refresh again
after a failure gives the same table.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timedelta, timezone
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from layerwell.errors import ConfigError, MissingInputError
from layerwell.operators.lineage import (
    BRONZE_INGESTED_AT,
    SILVER_RUN_ID,
    SOURCE_FILE,
    SOURCE_KEY,
)
from layerwell.operators.quality import (
    CRITICAL,
    RESULT_SCHEMA,
    WARNING,
    Check,
    CheckResult,
    collect_results,
    enforce,
    enforce_schema_checks,
    key_uniqueness,
    observe_checks,
    observed_results,
    partition_keys_exist,
    record_timestamp,
    table_checks,
)
from layerwell.operators.selection import anti
from layerwell.plans.builders import Builder, Period
from layerwell.plans.layers import (
    BATCH_HELPERS,
    LOST_CELLS,
    NULL_KEYS,
    bronze_frame,
    gold_frame,
    keys_proved_unique,
    silver_frame,
)
from layerwell.plans.registry import Registry
from layerwell.session import require_utc, table_scratch_path
from layerwell.sinks.appends import append_rows
from layerwell.sinks.audit import RunRecord, append_files, append_runs, file_table
from layerwell.sinks.jdbc import publish_table
from layerwell.sinks.parquet import (
    Draft,
    add_to_draft,
    draft_table,
    empty_draft,
    merge_partitions,
    overwrite_partitions,
    partition_names,
    publish_draft,
    stage,
    write_table,
)
from layerwell.sources.delimited import BAD_LINE
from layerwell.sources.listing import (
    expected_files,
    files_to_acquire,
    key_collisions,
    list_files,
    new_files,
    newest_file,
)
from layerwell.sources.manifest import load_manifest, record_files
from layerwell.sources.table_log import Files, changes_since, table_state
from layerwell.sources.tables import read_partitions, read_snapshot, read_table, read_window
from layerwell.spec import PipelineConfig, TableSpec

log = logging.getLogger(__name__)

# Files whose paths the driver names in one read. Larger backlogs are worked
# off in rounds, each of which is complete and recorded.
FILE_ORDER = "__file_order"
FILES_PER_ROUND = 20_000

# Changed days or months of a gold table up to which only these are rebuilt.
MOST_PERIODS = 400


FILE_COLUMNS = ("path", "source_key", "modified_at")
FILE_SCHEMA = "path string, source_key string, modified_at timestamp"
QUALITY_SCHEMA = T.StructType([
    *(T.StructField(name, T.StringType()) for name in ("run_id", "layer", "table")),
    *RESULT_SCHEMA.fields,
])


@dataclass(frozen=True)
class Outcome:
    """What a refresh did: files used, partitions and rows written."""

    files: int = 0
    partitions: int = 0
    rows: int = 0

    def __add__(self, other: Outcome) -> Outcome:
        return Outcome(
            self.files + other.files,
            self.partitions + other.partitions,
            self.rows + other.rows,
        )


@dataclass(frozen=True)
class Lake:
    """Where the layers live. Any file system Spark can write to will do."""

    root: str

    def landing(self, table: str) -> str:
        return f"{self.root}/landing/{table}"

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def manifest(self, layer: str, table: str) -> str:
        return f"{self.root}/control/manifest/{layer}/{table}"

    @property
    def audit(self) -> str:
        return f"{self.root}/control/audit"

    @property
    def quality(self) -> str:
        return f"{self.root}/control/quality"


@dataclass
class Run:
    """One run: session, configuration, registered functions, identity, clock."""

    spark: SparkSession
    config: PipelineConfig
    lake: Lake
    transforms: Registry
    builders: Registry
    run_id: str
    now: datetime
    code_version: str | None = None
    results: list[CheckResult] = field(default_factory=list)
    _pending: list[RunRecord] = field(default_factory=list, repr=False)
    _checked: list[tuple] = field(default_factory=list, repr=False)
    _deferred: bool = field(default=False, repr=False)

    def __post_init__(self) -> None:
        if self.now.tzinfo is None:
            raise ValueError("the clock of a run must carry a time zone")
        require_utc(self.spark)

    def manifest(self, layer: str, table: str) -> DataFrame:
        """Recorded files as of now."""
        return load_manifest(self.spark, self.lake.manifest(layer, table))

    @contextmanager
    def recording(self) -> Iterator[None]:
        """Gather audit records and check results and store them at the end,
        also when something fails on the way."""
        self._deferred = True
        try:
            yield
        finally:
            self._deferred = False
            self.keep_records()

    def keep_records(self) -> None:
        """Store audit records and check results gathered so far."""
        if self._deferred:
            return
        if self._checked:
            rows = self.spark.createDataFrame(self._checked, QUALITY_SCHEMA)
            append_rows(rows.coalesce(1), self.lake.quality)
        if self._pending:
            append_runs(self.spark, self.lake.audit, *self._pending)
        self._checked, self._pending = [], []

    def staging(self, layer: str, table: str) -> str:
        """One place per table: a run replaces what the previous run staged."""
        return table_scratch_path(self.spark, f"{self.lake.root}/{table}", layer)


# --------------------------------------------------------------------- bronze


def refresh_bronze(run: Run, table: str) -> int:
    """Ingest landing files and return how many.

    ``append`` takes files that are neither recorded nor present in bronze,
    ``latest_snapshot`` only the newest file unless it was taken already,
    ``overwrite`` all files: what they hold now becomes the table, so that rows
    of a file that was removed or emptied go. A missing landing folder changes nothing.
    """
    source, spec = run.config.source(table), _declared(run.config.bronze, table, "bronze")
    if not source.enabled:
        log.info("source %s is disabled", table)
        return 0
    started = datetime.now(timezone.utc)
    listing = list_files(
        run.spark, run.lake.landing(table), modified_after=source.modified_after
    )
    clash = key_collisions(listing).first()
    if clash:
        raise ConfigError(f"several landing files share the key {clash['source_key']!r}")

    manifest_path = run.lake.manifest("bronze", table)
    if source.mode == "overwrite":
        chosen = listing
    elif source.mode == "latest_snapshot":
        chosen = new_files(newest_file(listing), run.manifest("bronze", table))
    else:
        known = run.manifest("bronze", table)
        chosen = anti(new_files(listing, known), known, "source_key")

    path = run.lake.bronze(table)
    whole = empty_draft(run.spark, path) if source.mode == "overwrite" else None

    def ingest(files: DataFrame, paths: Sequence[Row]) -> Outcome:
        nonlocal whole
        names = [file["path"] for file in paths]
        df = bronze_frame(run.spark, names, source, spec, run.run_id, run.now)
        if whole:
            rows, bad = _counting(df, lambda observed: add_to_draft(observed, whole, [SOURCE_KEY]))
            whole = whole.with_columns(df.schema)
        else:
            rows, bad = write_bronze(df, path)
        if BAD_LINE in df.columns:
            result = CheckResult("bad_lines", BAD_LINE, WARNING, bad, rows, not bad)
            run.results.append(result)
            _record_quality(run, "bronze", table, [result])
        record_files(files, manifest_path, run.run_id, run.now, all_new=source.mode == "append")
        partitions = files.select(F.concat(F.lit(f"{SOURCE_KEY}="), "source_key"))
        return Outcome(len(paths), _audit_files(run, "bronze", table, files, partitions), rows)

    outcome = _in_rounds(run, chosen, ingest, run.staging("files-bronze", table))
    if whole and not outcome.files and whole.before and Files(run.spark, path).there(run.lake.landing(table)):
        # Spark lists no files without content: all there are may have been emptied.
        nothing = read_table(run.spark, path).limit(0)
        add_to_draft(nothing, whole, [SOURCE_KEY])
        whole = whole.with_columns(nothing.schema)
    if whole and whole.schema.fields:
        publish_draft(run.spark, whole)
    _audit(run, "bronze", table, started, outcome)
    return outcome.files


def write_bronze(df: DataFrame, path: str) -> tuple[int, int]:
    """Replace the partitions of the files in ``df``; the number of rows, and of
    bad lines among them. Nothing is exchanged: each task writes the rows it has read."""
    return _counting(df, lambda observed: overwrite_partitions(observed, path, [SOURCE_KEY]))


def _counting(df: DataFrame, store: Callable[[DataFrame], None]) -> tuple[int, int]:
    observation = Observation()
    is_bad = F.col(BAD_LINE).isNotNull() if BAD_LINE in df.columns else F.lit(False)
    counts = F.count(F.lit(1)).alias("rows"), F.count_if(is_bad).alias("bad")
    store(df.observe(observation, *counts))
    return observation.get["rows"], observation.get["bad"]


def bad_lines(run: Run, table: str) -> DataFrame:
    """Lines of text files that bronze keeps because they have more fields than
    there are names, with the file they are in. None of them reaches silver."""
    rows = read_table(run.spark, run.lake.bronze(table))
    if BAD_LINE not in rows.columns:
        rows = rows.withColumn(BAD_LINE, F.lit(None).cast("string"))
    return rows.where(F.col(BAD_LINE).isNotNull()).select(SOURCE_FILE, F.col(BAD_LINE).alias("line"))


def missing_from_landing(run: Run, table: str) -> DataFrame:
    """Files of the window that a downloader still has to fetch, newest first."""
    source = run.config.source(table)
    if source.acquisition != "http_download":
        raise ConfigError(f"source {table} is not downloaded")
    template = source.path_template
    first, last = run.config.window(run.now)
    expected = expected_files(
        run.spark,
        first,
        last,
        template["filename_pattern"],
        template.get("base_url"),
        template.get("date_format"),
    )
    recorded = run.manifest("bronze", table)
    landed = list_files(run.spark, run.lake.landing(table))
    present = recorded.select("source_key").union(landed.select("source_key"))
    return files_to_acquire(expected, present).orderBy(F.col("day").desc())


# --------------------------------------------------------------------- silver


def refresh_silver(run: Run, table: str) -> int:
    """Bring a silver table up to date and return the number of files used.

    ``latest_snapshot`` replaces the table with the newest file, ``overwrite``
    rebuilds it from all files, ``append`` merges new files into the partitions
    they touch.
    """
    source, spec = run.config.source(table), _declared(run.config.silver, table, "silver")
    if not source.enabled:
        log.info("source %s is disabled", table)
        return 0
    if not spec.primary_keys:
        raise ConfigError(f"silver table {table} has no primary key")
    started = datetime.now(timezone.utc)
    ingested = run.manifest("bronze", table)
    manifest_path = run.lake.manifest("silver", table)

    if source.mode == "latest_snapshot":
        order = [F.col(c).desc() for c in ("processed_at", "modified_at", "path")]
        chosen = ingested.orderBy(*order).limit(1)
    elif source.mode == "overwrite":
        chosen = ingested
    else:
        chosen = new_files(ingested, run.manifest("silver", table))

    def merge(files: DataFrame, batch: Sequence[Row]) -> Outcome:
        bronze = _read_bronze(run, table, [file["source_key"] for file in batch])
        outcome = Outcome()
        if bronze is not None:
            outcome = _refresh_silver_batch(run, spec, bronze, source.mode, files)
        record_files(files, manifest_path, run.run_id, run.now, all_new=source.mode == "append")
        return outcome + Outcome(len(batch))

    if source.mode == "overwrite":
        files = chosen.select(*FILE_COLUMNS)
        outcome = Outcome(files.select("path").distinct().count())
        batch = _read_bronze(run, table) if outcome.files else None
        if batch is not None:
            outcome += _refresh_silver_batch(run, spec, batch, source.mode, files)
            record_files(files, manifest_path, run.run_id, run.now, all_new=source.mode == "append")
    else:
        outcome = _in_rounds(run, chosen, merge, run.staging("files-silver", table))
    _audit(run, "silver", table, started, outcome)
    return outcome.files


def _refresh_silver_batch(
    run: Run, spec: TableSpec, bronze: DataFrame, mode: str, files: DataFrame
) -> Outcome:
    """Transform, check and store one batch, which stems from ``files``."""
    transform = run.transforms.get(spec.name)
    everything = mode == "overwrite"
    dropped = Observation()
    batch = silver_frame(
        bronze, spec, transform, run.run_id, run.now, across_files=everything, observation=dropped
    )
    extra: list[Check] = []
    if spec.partition_keys:
        extra.append(partition_keys_exist(batch, spec.partition_keys))
    if spec.record_timestamp:
        extra.append(record_timestamp(batch, spec.record_timestamp))
    scope = [] if everything else [SOURCE_FILE]
    proved = keys_proved_unique(bronze, spec, transform)
    staged, rows = _stage_checked(
        run, "silver", batch, spec, extra, None if proved else [*scope, *spec.primary_keys]
    )

    observed = dropped.get
    nulls = observed[NULL_KEYS]
    if nulls:
        log.warning("silver %s: %s rows without a key were left out", spec.name, nulls)
    run.results.append(
        CheckResult("null_keys", ",".join(spec.primary_keys), WARNING, nulls, rows + nulls, not nulls)
    )
    lost = [
        CheckResult("lost_cells", name.removeprefix(LOST_CELLS), WARNING, cells, rows + nulls, False)
        for name, cells in observed.items() if name.startswith(LOST_CELLS) and cells
    ]
    run.results += lost
    _record_quality(run, "silver", spec.name, lost)

    path = run.lake.silver(spec.name)
    if mode == "append":
        incoming, file_order = _with_file_order(staged, files)
        merge_partitions(
            incoming,
            path,
            spec.partition_keys,
            spec.primary_keys,
            spec.record_timestamp,
            incoming_order=[F.col(c) for c in (*file_order, BRONZE_INGESTED_AT, *BATCH_HELPERS)],
            helper_columns=(*file_order, *BATCH_HELPERS),
            staged=True,
            # File and position identify a row.
            order_settles=set(BATCH_HELPERS) <= set(incoming.columns),
        )
    elif mode == "overwrite" and spec.partition_keys:
        write_table(staged.drop(*BATCH_HELPERS), path, spec.partition_keys)
    else:
        write_table(staged.drop(*BATCH_HELPERS), path)
    partitions = partition_names(staged, spec.partition_keys)
    return Outcome(0, _audit_files(run, "silver", spec.name, files, partitions), rows)


def _with_file_order(batch: DataFrame, files: DataFrame) -> tuple[DataFrame, list[str]]:
    """Adds when the file of each row was modified, so that a tie goes to the
    older file within a round as it does between rounds. A stream does not know
    the times; it takes files in the order of their arrival."""
    if "modified_at" not in files.columns:
        return batch, []
    times = files.select(
        F.substring_index("path", "/", -1).alias(SOURCE_FILE), F.struct("modified_at", "path").alias(FILE_ORDER)
    ).groupBy(SOURCE_FILE).agg(F.min(FILE_ORDER).alias(FILE_ORDER))
    return batch.join(times, SOURCE_FILE, "left"), [FILE_ORDER]


def merge_bronze_batch(run: Run, table: str, bronze: DataFrame) -> int:
    """Merge one batch of bronze rows into a silver table, as a stream does."""
    spec = _declared(run.config.silver, table, "silver")
    files = bronze.select(F.col(SOURCE_FILE).alias("path")).distinct()
    return _refresh_silver_batch(run, spec, bronze, "append", files).rows


def _read_bronze(
    run: Run, table: str, keys: Sequence[str] | None = None
) -> DataFrame | None:
    """Bronze rows, of the given source files if any are given. None if the
    files held no rows, so that bronze has no table yet."""
    path = run.lake.bronze(table)
    try:
        if keys is None:
            df = read_table(run.spark, path)
        else:
            df = read_partitions(run.spark, path, SOURCE_KEY, keys)
    except MissingInputError:
        log.info("bronze %s has no rows yet", table)
        return None
    return df.drop(SOURCE_KEY)


# ----------------------------------------------------------------------- gold


def gold_order(config: PipelineConfig) -> list[str]:
    """Enabled gold tables, each after the gold tables it reads."""
    wanted = {n: s for n, s in config.gold.items() if s.enabled}
    graph = {
        name: [i.table for i in spec.inputs if i.layer == "gold" and i.table in wanted]
        for name, spec in wanted.items()
    }
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as cycle:
        raise ConfigError(f"gold tables depend on each other: {cycle.args[1]}") from cycle


def build_gold(
    run: Run, tables: Sequence[str] | None = None, from_scratch: bool = False
) -> list[str]:
    """Bring gold tables up to date in dependency order and return their names.

    A table whose builder declares the period its rows stem from is rebuilt for
    the periods that changed since its last build; one whose inputs have not
    changed at all stays as it is. Everything else, or all ``from_scratch``, is
    built anew.
    """
    order = [t for t in gold_order(run.config) if tables is None or t in tables]
    for table in order:
        _build_gold_table(run, run.config.gold[table], from_scratch)
    return order


def _build_gold_table(run: Run, spec: TableSpec, from_scratch: bool) -> None:
    started = datetime.now(timezone.utc)
    builder, path = run.builders.get(spec.name), run.lake.gold(spec.name)
    made_from = _made_from(run, spec, builder)
    periods = None if from_scratch else _periods_to_build(run, spec, builder, made_from)
    if periods is not None and not periods:
        _audit(run, "gold", spec.name, started, Outcome(len(spec.inputs)))
        return

    inputs = {i.table: _gold_input(run, i.layer, i.table) for i in spec.inputs}
    if periods is None:
        df = gold_frame(inputs, spec, builder)
    else:
        period = builder.period
        inputs[period.table] = inputs[period.table].where(_in_periods(period, periods))
        same = F.to_date(period.result).isin(sorted(periods))
        df = (
            read_table(run.spark, path, spec.column_names).where(~same)
            .unionByName(gold_frame(inputs, spec, builder).where(same))
        )
    proved = getattr(builder, "unique", ()) == tuple(spec.primary_keys)
    draft, rows = _draft_checked(run, df, spec, path, None if proved else spec.primary_keys)
    publish_draft(run.spark, draft, spec.primary_keys, made_from)
    files = run.spark.createDataFrame(
        [(f"{i.layer}/{i.table}",) for i in spec.inputs], "path string"
    )
    written = run.spark.createDataFrame([(f"gold/{spec.name}/{draft.folder}",)], "path string")
    partitions = _audit_files(run, "gold", spec.name, files, written)
    _audit(run, "gold", spec.name, started, Outcome(len(inputs), partitions, rows))


def _made_from(run: Run, spec: TableSpec, builder: Callable) -> dict | None:
    """What determines a gold table: the state of its inputs, the window, and the
    settings of builder and columns. None if that cannot be told, as a function
    may do anything."""
    if not isinstance(builder, Builder):
        return None
    states = {
        f"{i.layer}/{i.table}": table_state(run.spark, getattr(run.lake, i.layer)(i.table))
        for i in spec.inputs
    }
    if None in states.values():
        return None
    first, last = run.config.window(run.now)
    return {
        "inputs": {name: state.number for name, state in states.items()},
        "window": [first.isoformat(), last.isoformat()],
        "settings": repr((builder, spec, run.code_version)),
    }


def _periods_to_build(
    run: Run, spec: TableSpec, builder: Callable, made_from: dict | None
) -> set[date] | None:
    """First days of the periods that changed since the last build; None if that
    cannot be told and everything is to be built."""
    state = table_state(run.spark, run.lake.gold(spec.name))
    if made_from is None or state is None or state.inputs is None:
        return None
    before = state.inputs
    if before["settings"] != made_from["settings"] or before["inputs"].keys() != made_from["inputs"].keys():
        return None
    if before["inputs"] == made_from["inputs"] and (
        before["window"] == made_from["window"] or all(i.layer == "gold" for i in spec.inputs)
    ):
        return set()
    period = builder.period
    if period is None or len(spec.inputs) != 1 or spec.inputs[0].layer != "silver":
        return None
    silver = run.config.silver[period.table]
    if list(silver.partition_keys) != [period.date_column] or run.config.source(period.table).mode != "append":
        return None
    name = f"silver/{period.table}"
    touched = changes_since(run.spark, run.lake.silver(period.table), before["inputs"][name])
    if touched is None:
        return None
    try:
        days = {date.fromisoformat(text[:10]) for text in touched if text is not None}
        for old, new in zip(before["window"], made_from["window"]):
            low, high = sorted(date.fromisoformat(text[:10]) for text in (old, new))
            if old != new:
                if (high - low).days > MOST_PERIODS:
                    return None
                days |= {low + timedelta(days=n) for n in range((high - low).days + 1)}
    except ValueError:
        return None
    periods = {day.replace(day=1) if period.unit == "month" else day for day in days}
    return periods if len(periods) <= MOST_PERIODS else None


def _in_periods(period: Period, starts: set[date]) -> Column:
    """Rows of the given days or months, as ranges that prune partitions."""
    column, wanted = F.col(period.date_column), F.lit(False)
    for first in sorted(starts):
        if period.unit == "month":
            after = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
        else:
            after = first + timedelta(days=1)
        wanted = wanted | ((column >= F.lit(first)) & (column < F.lit(after)))
    return wanted


def _gold_input(run: Run, layer: str, table: str) -> DataFrame:
    if layer == "gold":
        return read_table(run.spark, run.lake.gold(table))
    source, spec = run.config.source(table), _declared(run.config.silver, table, "silver")
    first, last = run.config.window(run.now)
    path = run.lake.silver(table)
    if source.mode == "latest_snapshot":
        stamp = spec.record_timestamp
        if stamp is None:
            raise ConfigError(f"snapshot table {table} declares no record timestamp")
        return read_snapshot(run.spark, path, SILVER_RUN_ID, stamp, first, last)
    if not spec.partition_keys:
        return read_table(run.spark, path)
    return read_window(run.spark, path, spec.partition_keys[0], first, last)


# -------------------------------------------------------------------- serving


def serve_gold(
    run: Run,
    url: str,
    properties: Mapping[str, str] | None = None,
    publish: Callable[..., int] = publish_table,
) -> dict[str, int]:
    """Replace the database table of every enabled gold table."""
    served = {}
    for table in gold_order(run.config):
        df = read_table(run.spark, run.lake.gold(table))
        served[table] = publish(df, url, table, properties)
    return served


def run_all(
    run: Run, url: str | None = None, properties: Mapping[str, str] | None = None
) -> list[str]:
    """Bronze, silver, gold and, given a database, serving."""
    with run.recording():
        for table in run.config.bronze:
            refresh_bronze(run, table)
        for table in run.config.silver:
            refresh_silver(run, table)
        built = build_gold(run)
    if url:
        serve_gold(run, url, properties)
    return built


# -------------------------------------------------------------------- helpers


def _declared(tables: Mapping[str, TableSpec], table: str, layer: str) -> TableSpec:
    if table not in tables:
        raise ConfigError(f"table {table} is not declared in layer {layer}")
    return tables[table]


def _in_rounds(
    run: Run,
    chosen: DataFrame,
    work: Callable[[DataFrame, Sequence[Row]], Outcome],
    staging: str,
) -> Outcome:
    """Apply ``work`` to the chosen files, oldest first, a bounded number at a
    time. A choice too long for one round is stored first, so that it stays
    fixed while it is worked off and the driver never holds more of it than one
    round needs."""
    files = chosen.select(*FILE_COLUMNS).distinct()
    batch = _first_files(files)
    if len(batch) > FILES_PER_ROUND:
        files = stage(files, staging)
        batch = _first_files(files)
    outcome = Outcome()
    while batch:
        more, batch = len(batch) > FILES_PER_ROUND, batch[:FILES_PER_ROUND]
        outcome += work(run.spark.createDataFrame(batch, FILE_SCHEMA), batch)
        batch = _first_files(files.where(_after(batch[-1]))) if more else []
    return outcome


def _first_files(files: DataFrame) -> list[Row]:
    return files.orderBy("modified_at", "path").limit(FILES_PER_ROUND + 1).collect()


def _after(row) -> Column:
    """Rows that follow ``row`` when ordered by time and path."""
    time, path = F.col("modified_at"), F.col("path")
    return (time > row["modified_at"]) | ((time == row["modified_at"]) & (path > row["path"]))


def _stage_checked(
    run: Run,
    layer: str,
    df: DataFrame,
    spec: TableSpec,
    extra: Sequence[Check],
    unique: Sequence[str] | None,
) -> tuple[DataFrame, int]:
    """Store ``df`` in the scratch folder, checking it on the way; raise if a
    critical check fails. ``unique`` names the key to verify, unless it holds
    by construction. Returns the stored rows and their number."""

    def store(observed: DataFrame) -> DataFrame:
        return stage(observed, run.staging(layer, spec.name))

    return _checked(run, layer, df, spec, extra, unique, store, lambda staged: staged)


def _draft_checked(
    run: Run, df: DataFrame, spec: TableSpec, path: str, unique: Sequence[str] | None
) -> tuple[Draft, int]:
    """As :func:`_stage_checked` for rows that need no merging: they are written
    beside the table at ``path``, to become it once they have passed."""
    return _checked(
        run, "gold", df, spec, [], unique,
        lambda observed: draft_table(observed, path), lambda draft: draft.rows(run.spark),
    )


def _checked(run, layer, df, spec, extra, unique, store, rows_of):
    checks = [*table_checks(df, spec), *extra]
    enforce_schema_checks(*checks)
    observed, observation = observe_checks(df, checks)
    stored = store(observed)
    results = observed_results(checks, observation)
    rows = results[0].total
    if unique:
        results += collect_results(key_uniqueness(rows_of(stored), unique))
    run.results += results
    _record_quality(run, layer, spec.name, results)
    enforce(results)
    return stored, rows


def _record_quality(run: Run, layer: str, table: str, results: Sequence[CheckResult]) -> None:
    names = RESULT_SCHEMA.names
    run._checked += [(run.run_id, layer, table, *(getattr(r, n) for n in names)) for r in results]
    if any(not r.passed and r.severity == CRITICAL for r in results):
        run.keep_records()


def _audit_files(
    run: Run, layer: str, table: str, inputs: DataFrame, outputs: DataFrame
) -> int:
    """Record used files and written partitions; the number of the latter."""
    used = file_table(inputs.select("path"), run.run_id, layer, table, "input")
    written = file_table(outputs, run.run_id, layer, table, "output")
    observation = Observation()
    count = F.count_if(F.col("role") == "output").alias("outputs")
    append_files(used.union(written).observe(observation, count), run.lake.audit)
    return observation.get["outputs"]


def _audit(run: Run, layer: str, table: str, started: datetime, outcome: Outcome) -> None:
    record = RunRecord(
        run_id=run.run_id,
        layer=layer,
        table=table,
        start_time=started,
        inputs=outcome.files,
        outputs=outcome.partitions,
        rows_written=outcome.rows,
        code_version=run.code_version,
        configs={
            "pipeline": {"name": run.config.name, "timezone": run.config.timezone},
            "window": run.config.window(run.now),
            "source": asdict(run.config.sources[table]) if table in run.config.sources else {},
            "schema": getattr(run.config, layer)[table].dtypes,
        },
    )
    run._pending.append(record)
    run.keep_records()
