"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession

from layerwell.errors import ConfigError

# Settings every run wants, whatever the cluster. Shuffle partition counts are
# left to adaptive execution: it starts high and merges or splits by real size.
BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}

_local_scratch: dict[str, str] = {}


def build_session(
    app_name: str, master: str | None = None, **settings: str
) -> SparkSession:
    """Session with the library's base settings; ``settings`` override them
    (write dots as double underscores: ``spark__ui__enabled="false"``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**BASE_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Stop early when timestamps would be read in another zone than UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ConfigError(
            f"spark.sql.session.timeZone must be UTC for layered tables, not {zone}"
        )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own: on a
    cluster the executors and a restarted driver must all see the same files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ConfigError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="layerwell-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/layerwell/{label}-{uuid.uuid4().hex}"


def table_scratch_path(spark: SparkSession, table_path: str, label: str) -> str:
    """The place for intermediate data of one table. The next use replaces what
    the previous one left, so repeated runs and micro-batches do not pile up."""
    readable = "".join(c if c.isalnum() else "_" for c in table_path)
    exact = hashlib.sha256(table_path.encode()).hexdigest()[:16]
    return f"{scratch_root(spark)}/layerwell/{readable}-{exact}-{label}"
