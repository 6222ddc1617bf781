"""Publish the silver tables to a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from weirflow.sinks import write_jdbc
from weirflow.sinks.jdbc import CONNECTIONS
from weirflow.sources import read_dataset

# Published tables, dimensions before the fact.
TABLES = ("dim_rate_code", "dim_vendor", "dim_zone", "fact_trips")


def publish(
    spark: SparkSession,
    root: str,
    url: str,
    properties: Mapping[str, str],
    connections: int = CONNECTIONS,
) -> None:
    """Open all tables first, so that a missing one stops before any write."""
    tables = {name: read_dataset(spark, f"{root}/silver/{name}") for name in TABLES}
    for name, df in tables.items():
        write_jdbc(df, url, name, properties, connections)
