"""Zone lookup and static dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from weirflow import schemas
from weirflow.operators import stamp_date
from weirflow.sinks import write_table
from weirflow.sources import read_csv, read_dataset, static_dim

# Fixed value: folder and file name of the zone drop.
TOPIC = "taxi_zone_lookup"


def load_zones_bronze(
    spark: SparkSession,
    root: str,
    process_date: str | dt.date | None = None,
    schema: T.StructType | None = None,
) -> None:
    zones = read_csv(spark, f"{root}/landing/{TOPIC}/{TOPIC}.csv", schema)
    write_table(stamp_date(zones, process_date), f"{root}/bronze/{TOPIC}")


def build_dim_zone(
    spark: SparkSession, root: str, process_date: str | dt.date | None = None
) -> None:
    zones = read_dataset(spark, f"{root}/bronze/{TOPIC}")
    write_table(stamp_date(zones, process_date), f"{root}/silver/dim_zone")


def build_static_dims(spark: SparkSession, root: str) -> None:
    vendors = static_dim(spark, schemas.VENDORS, schemas.VENDOR)
    write_table(vendors, f"{root}/silver/dim_vendor")
    rate_codes = static_dim(spark, schemas.RATE_CODES, schemas.RATE_CODE)
    write_table(rate_codes, f"{root}/silver/dim_rate_code")
