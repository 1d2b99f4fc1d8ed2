"""Publishing finished tables to a relational database."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def publish_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    max_connections: int = 8,
    batch_size: int = 10_000,
    attempts: int = 2,
) -> int:
    """Replace ``table`` with the rows of ``df`` and return their number.

    A task that is repeated after its executor was lost may insert its rows
    twice, so the row count is read back and the replacement repeated when it
    is off. ``df`` should read a stored table, which makes counting it cheap.
    ``max_connections`` bounds the load on the database.
    """
    options = {**(properties or {}), "batchsize": str(batch_size)}
    rows = df.coalesce(max_connections)
    expected = df.count()
    for attempt in range(1, attempts + 1):
        rows.write.mode("overwrite").jdbc(url, table, properties=options)
        stored = df.sparkSession.read.jdbc(url, table, properties=dict(properties or {})).count()
        if stored == expected:
            return stored
        log.warning("%s: %s rows stored, %s expected (attempt %s)", table, stored, expected, attempt)
    raise RuntimeError(f"table {table} holds {stored} rows instead of {expected}")
