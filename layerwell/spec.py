"""Declarative description of sources, tables and the pipeline window."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from layerwell.errors import ConfigError
from layerwell.functions.casting import spark_type

INGESTION_MODES = ("append", "overwrite", "latest_snapshot")
ACQUISITION_METHODS = ("manual_drop", "http_download")
INPUT_LAYERS = ("silver", "gold")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str | None = None
    source: str | None = None
    nullable: bool = True
    primary_key: bool = False
    partition_key: bool = False
    record_timestamp: bool = False
    # Date patterns of a text source, tried in this order, before ISO.
    formats: tuple[str, ...] = ()


@dataclass(frozen=True)
class InputSpec:
    alias: str
    layer: str
    table: str


@dataclass(frozen=True)
class TableSpec:
    """Columns with their roles; gold tables also name their inputs."""

    name: str
    columns: tuple[ColumnSpec, ...] = ()
    required_columns: tuple[str, ...] = ()
    enabled: bool = True
    inputs: tuple[InputSpec, ...] = ()

    @classmethod
    def from_mapping(cls, name: str, raw: Mapping[str, Any]) -> TableSpec:
        columns = tuple(
            ColumnSpec(name=column, **{**(attributes or {}), "formats": _patterns(attributes)})
            for column, attributes in (raw.get("columns") or {}).items()
        )
        inputs = tuple(
            InputSpec(alias, given["layer"], given["table_name"])
            for alias, given in (raw.get("inputs") or {}).items()
        )
        unknown = [i.layer for i in inputs if i.layer not in INPUT_LAYERS]
        if unknown:
            raise ConfigError(f"table {name}: unknown input layer(s) {unknown}")
        return cls(
            name=name,
            columns=columns,
            required_columns=tuple(raw.get("required_columns") or ()),
            enabled=raw.get("enabled", True),
            inputs=inputs,
        )

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def dtypes(self) -> dict[str, str]:
        return {c.name: c.type for c in self.columns if c.type}

    @property
    def formats(self) -> dict[str, tuple[str, ...]]:
        return {c.name: c.formats for c in self.columns if c.formats}

    @property
    def renames(self) -> dict[str, str]:
        return {c.source: c.name for c in self.columns if c.source}

    @property
    def primary_keys(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]

    @property
    def partition_keys(self) -> list[str]:
        return [c.name for c in self.columns if c.partition_key]

    @property
    def non_nullable(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def record_timestamp(self) -> str | None:
        flagged = [c.name for c in self.columns if c.record_timestamp]
        if len(flagged) > 1:
            raise ConfigError(
                f"table {self.name}: several record timestamps declared: {flagged}"
            )
        return flagged[0] if flagged else None

    def struct_type(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, spark_type(c.type or "string")) for c in self.columns]
        )


@dataclass(frozen=True)
class SourceSpec:
    """How the files of one feed are found and read."""

    name: str
    mode: str
    acquisition: str = "manual_drop"
    file_type: str = "csv"
    compression: str | None = None
    enabled: bool = True
    reader: Mapping[str, Any] = field(default_factory=dict)
    path_template: Mapping[str, Any] = field(default_factory=dict)
    # Leaves older landing files unlisted where the folder holds a long history.
    modified_after: str | None = None

    def __post_init__(self) -> None:
        if self.mode not in INGESTION_MODES:
            raise ConfigError(f"source {self.name}: unknown ingestion mode {self.mode}")
        if self.acquisition not in ACQUISITION_METHODS:
            raise ConfigError(
                f"source {self.name}: unknown acquisition method {self.acquisition}"
            )

    @classmethod
    def from_mapping(cls, name: str, raw: Mapping[str, Any]) -> SourceSpec:
        # Existing configurations spell the key without its "c".
        acquisition = raw.get("acquisition_method", raw.get("aquisition_method"))
        return cls(
            name=name,
            mode=raw.get("ingestion_mode"),
            acquisition=acquisition,
            file_type=raw.get("file_type", "csv"),
            compression=raw.get("compression"),
            enabled=raw.get("enabled", True),
            reader=raw.get("reader") or {},
            path_template=raw.get("path_template") or {},
            modified_after=raw.get("modified_after"),
        )


@dataclass(frozen=True)
class PipelineConfig:
    """Everything one run needs to know."""

    name: str
    start_date: date
    end_date: date | None = None
    timezone: str = "UTC"
    sources: Mapping[str, SourceSpec] = field(default_factory=dict)
    bronze: Mapping[str, TableSpec] = field(default_factory=dict)
    silver: Mapping[str, TableSpec] = field(default_factory=dict)
    gold: Mapping[str, TableSpec] = field(default_factory=dict)

    @classmethod
    def from_mappings(
        cls,
        pipeline: Mapping[str, Any],
        sources: Mapping[str, Any],
        schemas: Mapping[str, Any],
    ) -> PipelineConfig:
        """Build from the three documents ``pipeline``, ``sources``, ``schemas``."""
        head = pipeline["pipeline"]
        window = head["execution"]
        layers = schemas["schemas"]

        def tables(layer: str) -> dict[str, TableSpec]:
            declared: Iterable = (layers.get(layer) or {}).items()
            return {n: TableSpec.from_mapping(n, raw or {}) for n, raw in declared}

        return cls(
            name=head["name"],
            start_date=_as_date(window["start_date"]),
            end_date=_as_date(window["end_date"]) if window.get("end_date") else None,
            timezone=head.get("timezone", "UTC"),
            sources={
                n: SourceSpec.from_mapping(n, raw)
                for n, raw in sources["sources"].items()
            },
            bronze=tables("bronze"),
            silver=tables("silver"),
            gold=tables("gold"),
        )

    @classmethod
    def from_folder(cls, folder: str | Path) -> PipelineConfig:
        """Read ``pipeline.yaml``, ``sources.yaml`` and ``schemas.yaml``."""
        try:
            import yaml
        except ImportError as missing:
            raise ConfigError("PyYAML is needed to read YAML files") from missing
        documents = [
            yaml.safe_load((Path(folder) / f"{name}.yaml").read_text())
            for name in ("pipeline", "sources", "schemas")
        ]
        return cls.from_mappings(*documents)

    def source(self, table: str) -> SourceSpec:
        if table not in self.sources:
            raise ConfigError(f"no source is declared for table {table}")
        return self.sources[table]

    def window(self, now: datetime) -> tuple[date, date]:
        """First day and last day, or the current instant where none is set."""
        return self.start_date, self.end_date or now


def _patterns(attributes: Mapping[str, Any] | None) -> tuple[str, ...]:
    """One pattern may stand by itself instead of in a list."""
    given = (attributes or {}).get("formats") or ()
    return (given,) if isinstance(given, str) else tuple(given)


def _as_date(value: str | date | datetime) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)
