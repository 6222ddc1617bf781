"""Load dates, reject marks and schema conformance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_process_date(process_date: str | dt.date | None = None) -> dt.date:
    """The load date: given, or today in the session's zone. Bad text raises."""
    if process_date is None:
        return SparkSession.active().range(1).select(F.current_date()).first()[0]
    if isinstance(process_date, dt.datetime):
        return process_date.date()
    if isinstance(process_date, dt.date):
        return process_date
    return dt.datetime.strptime(process_date, "%Y-%m-%d").date()


def stamp_date(df: DataFrame, process_date: str | dt.date | None = None) -> DataFrame:
    """Set (or replace) ``processing_date``; the clock's date when none is given."""
    if process_date is None:
        return df.withColumn("processing_date", F.current_date())
    return df.withColumn("processing_date", F.lit(resolve_process_date(process_date)))


def stamp_reject(df: DataFrame, reason: str, now: Column | dt.datetime | None = None) -> DataFrame:
    """Add ``error_timestamp`` and ``error_reason``."""
    if now is None:
        now = F.current_timestamp()
    elif not isinstance(now, Column):
        now = F.lit(now)
    return df.withColumns({"error_timestamp": now, "error_reason": F.lit(reason)})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared columns; a missing one becomes null. Names match
    whatever their case, as they do for Spark's readers."""
    present = {name.lower() for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
