"""Taxi trips: landing -> bronze -> silver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow import schemas
from weirflow.functions import duration_hms, duration_secs, month_number, surrogate_key, year_number
from weirflow.operators import stamp_date, stamp_reject
from weirflow.sinks import replace_partitions, write_snapshot
from weirflow.sources import (
    SchemaRecord,
    drop_schemas,
    month_spine,
    read_dataset,
    read_evolved,
    read_months,
)
from weirflow.sources.months import SOURCE_MONTH

# Dataset name, and path of a monthly drop below the data root.
TOPIC = "yellow_taxi_trip"
DROP = "landing/yellow_taxi_trip/{month}/yellow_tripdata_{month}.parquet"
# Source columns that trips are derived from.
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
TRIP_KEY = ("VendorID", "tpep_pickup_datetime", "PULocationID")


class MonthSplit(NamedTuple):
    inside: DataFrame
    outside: DataFrame


def _bound(month: str, after: int, column_type: str) -> str:
    """The first day of a month, or of one ``after`` it, as the column's type."""
    number = int(month[:4]) * 12 + int(month[5:]) - 1 + after
    return f"CAST('{number // 12:04d}-{number % 12 + 1:02d}-01' AS {column_type})"


def _stray(pickup: str) -> Column:
    """Whether the pickup is not in the month of the drop."""
    owner = F.translate(SOURCE_MONTH, "-", "").cast("int")
    return ~(year_number(pickup) * 100 + month_number(pickup)).eqNullSafe(owner)


def stray_trips(drops: DataFrame, months: Sequence[str], pickup: str = PICKUP) -> DataFrame:
    """The rows of some drops whose pickup lies in another month, or in none.

    The bounds that hold for all of ``months`` are literals of the column's type
    that reach the scan: a load of one month skips every row group without
    strays. Drops of other months are not opened.
    """
    if not months:
        return drops.limit(0)
    column_type = drops.schema[pickup].dataType.simpleString()
    last, first_end = _bound(max(months), 0, column_type), _bound(min(months), 1, column_type)
    maybe = f"`{pickup}` IS NULL OR `{pickup}` < {last} OR `{pickup}` >= {first_end}"
    return drops.where(F.col(SOURCE_MONTH).isin(*months)).where(maybe).where(_stray(pickup))


def split_months(drops: DataFrame, months: Sequence[str], pickup: str = PICKUP) -> MonthSplit:
    """Rows whose pickup lies in the month of their drop, and the others, of drops
    with a ``source_month``. A monthly load then owns exactly its month's
    partition: stray rows cannot replace a neighbour month.
    """
    column_type = drops.schema[pickup].dataType.simpleString()
    start, end = _bound(min(months), 0, column_type), _bound(max(months), 1, column_type)
    owned = drops.where(f"`{pickup}` >= {start} AND `{pickup}` < {end}").where(~_stray(pickup))
    parts = {"year": year_number(pickup), "month": month_number(pickup)}
    return MonthSplit(owned.drop(SOURCE_MONTH).withColumns(parts), stray_trips(drops, months, pickup))


def load_trips_bronze(
    spark: SparkSession,
    root: str,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    process_date: str | dt.date | None = None,
    schema: T.StructType | None = None,
    now: dt.datetime | None = None,
    drop: str = DROP,
    evolve: bool = False,
) -> None:
    """Monthly files -> ``year``/``month`` partitions; the months loaded are
    replaced, all others stay.

    When months differ in types, give a ``schema`` that they are cast to, or let
    it ``evolve``: the months merge with all that were loaded before to one schema
    that holds them without loss, which is recorded (``read_trips_bronze`` reads
    with it); a month that does not merge stops the load before anything is replaced.
    """
    if evolve and schema is not None:
        raise ValueError("give a schema or let it evolve")
    months = month_spine(start, end)
    layout, as_came = f"{root}/{drop}", None
    if evolve:
        as_came = drop_schemas(spark, layout, months)
        schema = trips_schema(spark, root).add(as_came)
    drops = read_months(spark, layout, months, schema, as_came)
    # Strays are noticed in the pass that loads the others: only drops that have
    # some are read again. At most one entry per month reaches the driver.
    seen = Observation()
    with_strays = F.collect_set(F.when(_stray(PICKUP), F.col(SOURCE_MONTH))).alias("months")
    inside = split_months(drops.observe(seen, with_strays), months).inside
    replace_partitions(
        stamp_date(inside, process_date),
        f"{root}/bronze/{TOPIC}",
        [{"year": int(m[:4]), "month": int(m[5:])} for m in months],
    )
    replace_partitions(
        stamp_reject(
            stamp_date(stray_trips(drops, sorted(seen.get["months"])), process_date), schemas.REASON_MONTH, now
        ),
        f"{root}/rejected_data/{TOPIC}/out_of_month",
        [{SOURCE_MONTH: m} for m in months],
        fmt="csv",
    )


def trips_schema(spark: SparkSession, root: str) -> SchemaRecord:
    return SchemaRecord(spark, f"{root}/bronze/{TOPIC}_schemas")


def read_trips_bronze(spark: SparkSession, root: str) -> DataFrame:
    """All months of an evolving bronze table. Files keep the types they were
    written with; the scan widens them and gives the columns they lack as null."""
    return read_evolved(
        spark,
        f"{root}/bronze/{TOPIC}",
        trips_schema(spark, root).schema(),
        T.StructField("processing_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    )


def positive_trips(trips: DataFrame) -> DataFrame:
    """Trips with an amount and a distance above zero; null counts as neither."""
    return trips.where((F.col("total_amount") > 0) & (F.col("trip_distance") > 0))


def derive_trips(trips: DataFrame, null_as: str | None = None) -> DataFrame:
    """Duration (text and seconds) and trip key of positive trips. A null or
    negative duration is kept."""
    seconds = duration_secs(PICKUP, DROPOFF)
    return positive_trips(trips).withColumns(
        {
            "tpep_total_trip_time_str": duration_hms(seconds),
            "tpep_total_trip_time_secs": seconds,
            "trip_id": surrogate_key(*TRIP_KEY, null_as=null_as),
        }
    )


def build_fact_trips(
    spark: SparkSession,
    root: str,
    process_date: str | dt.date | None = None,
    months: Sequence[str] | None = None,
    evolve: bool = False,
) -> None:
    """All of bronze as a snapshot, or only the given ``YYYY-MM`` months: these
    are pruned at the scan and replaced in place. ``evolve`` says that bronze was
    loaded so."""
    trips = read_trips_bronze(spark, root) if evolve else read_dataset(spark, f"{root}/bronze/{TOPIC}")
    target = f"{root}/silver/fact_trips"
    if months is None:
        # Bronze files hold one month each, so no rebalance is needed.
        facts = derive_trips(stamp_date(trips, process_date))
        write_snapshot(facts, target, ["year", "month"], rebalance=False)
        return
    parts = [{"year": int(m[:4]), "month": int(m[5:])} for m in months]
    wanted = F.lit(False)
    for part in parts:
        wanted = wanted | ((F.col("year") == part["year"]) & (F.col("month") == part["month"]))
    facts = derive_trips(stamp_date(trips.where(wanted), process_date))
    replace_partitions(facts, target, parts)
