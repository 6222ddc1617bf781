"""Relational sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Fixed value: rows per insert batch.
BATCH_SIZE = 10_000
# Databases take few writers at a time; a large cluster would open thousands.
CONNECTIONS = 16


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    connections: int = CONNECTIONS,
) -> None:
    """Replace a database table. The caller supplies user, password, driver.

    Executors write in parallel over at most ``connections`` connections.
    """
    if connections < 1:
        raise ValueError(f"connections must be at least 1, not {connections}")
    settings = {"batchsize": str(BATCH_SIZE), "numPartitions": str(connections), **properties}
    df.write.jdbc(url, table, mode="overwrite", properties=settings)
