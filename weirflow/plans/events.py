"""Event stream load, event facts (batch and streaming) and the data check."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow import schemas
from weirflow.functions import letters_upper, parse_timestamp
from weirflow.operators import enrich, latest_by_key
from weirflow.operators.stamps import resolve_process_date
from weirflow.sinks import preview, preview_rows, write_snapshot
from weirflow.sources import read_dataset
from weirflow.streaming import (
    Compaction,
    dedup_stream,
    dedup_stream_by_id,
    stream_enriched,
    stream_json,
    stream_parquet,
    stream_to_parquet,
)

# The text of a line that is no JSON object.
RAW_LINE = "raw_line"
VALID_COLUMNS = [
    "event_id",
    "customer_id",
    "event_type",
    "event_timestamp",
    "processing_timestamp",
    "processing_date",
]
# Rejects also keep the text that did not parse, and say why they are here.
REJECT_COLUMNS = [*VALID_COLUMNS, "raw_event_timestamp", RAW_LINE, "error_reason"]
FACT_COLUMNS = [
    "event_id",
    "customer_id",
    "name",
    "email",
    "country",
    "event_type",
    "created_at",
    "event_timestamp",
    "processing_date",
]


def clean_events(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Parse and normalise; works on batches and streams. The clock columns
    are fixed within a micro-batch."""
    now = F.current_timestamp() if now is None else now
    line = F.col(RAW_LINE) if RAW_LINE in events.columns else F.lit(None).cast("string")
    return events.select(
        "event_id",
        "customer_id",
        letters_upper("event_type").alias("event_type"),
        parse_timestamp("event_timestamp").alias("event_timestamp"),
        now.alias("processing_timestamp"),
        F.to_date(now).alias("processing_date"),
        F.col("event_timestamp").alias("raw_event_timestamp"),
        line.alias(RAW_LINE),
        F.lit(schemas.REASON_TIMESTAMP).alias("error_reason"),
    )


def is_valid() -> Column:
    return F.col("event_timestamp").isNotNull()


def valid_events(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(is_valid()).select(*VALID_COLUMNS)


def rejected_events(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(~is_valid()).select(*REJECT_COLUMNS)


def stream_events(
    spark: SparkSession, root: str, every: str | None = "2 seconds", max_bytes: int | None = None
) -> tuple[StreamingQuery, StreamingQuery]:
    """JSON lines -> valid and rejected events: two exactly-once queries, each
    reading the source. ``every=None`` takes what is there and ends."""
    source = stream_json(
        spark, f"{root}/input_streaming/events", schemas.EVENTS, max_bytes, RAW_LINE
    )
    cleaned = clean_events(source)
    checkpoints = f"{root}/checkpoint_data"
    valid = stream_to_parquet(
        valid_events(cleaned), f"{root}/raw_data/events", f"{checkpoints}/clean_events", every=every
    )
    rejected = stream_to_parquet(
        rejected_events(cleaned),
        f"{root}/rejected_data/events",
        f"{checkpoints}/error_events",
        every=every,
    )
    return valid, rejected


def stream_events_once(
    spark: SparkSession, root: str, every: str | None = "2 seconds", max_bytes: int | None = None
) -> StreamingQuery:
    """The same rows, read and parsed once: one exactly-once query writes one
    dataset with the partition ``is_valid``. ``read_checked_events`` reads a side
    of it, and a stream can tail it."""
    source = stream_json(
        spark, f"{root}/input_streaming/events", schemas.EVENTS, max_bytes, RAW_LINE
    )
    checked = clean_events(source).withColumn("is_valid", is_valid())
    return stream_to_parquet(
        checked,
        f"{root}/raw_data/checked_events",
        f"{root}/checkpoint_data/checked_events",
        by=["is_valid", "processing_date"],
        every=every,
    )


def read_checked_events(spark: SparkSession, root: str, valid: bool) -> DataFrame:
    """The valid events, or the rejected ones: the other side is not read."""
    checked = read_dataset(spark, f"{root}/raw_data/checked_events")
    columns = VALID_COLUMNS if valid else REJECT_COLUMNS
    return checked.where(F.col("is_valid") == valid).select(*columns)


def fact_events(events: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Latest version of each event with its customer; an event of an unknown
    customer is dropped."""
    latest = latest_by_key(events, ["event_id"], ["event_timestamp", "processing_date"])
    attributes = ["name", "email", "country", "created_at"]
    return enrich(latest, dim_customer, "customer_id", attributes, how="inner").select(*FACT_COLUMNS)


def _compaction(spark: SparkSession, root: str) -> Compaction:
    return Compaction(spark, f"{root}/raw_data/events", f"{root}/raw_data/events_compacted")


def compact_events(spark: SparkSession, root: str, process_date: str | dt.date | None = None) -> list[str]:
    """Gather the valid events of the dates before ``process_date`` (today) in few
    files; returns the dates that were. The stream may run on."""
    return _compaction(spark, root).compact(resolve_process_date(process_date))


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """The valid events, those of compacted dates from their large files."""
    return _compaction(spark, root).read()


def build_fact_events(
    spark: SparkSession, root: str, dates: Iterable[str | dt.date] | None = None
) -> None:
    events = read_dataset(spark, f"{root}/raw_data/events", dates=dates)
    dim = read_dataset(spark, f"{root}/output/dim_customer")
    write_snapshot(fact_events(events, dim), f"{root}/output/fact_events", ["processing_date"])


def stream_fact_events(
    spark: SparkSession,
    root: str,
    keys: tuple[str, ...] = ("customer_id", "event_timestamp"),
    every: str | None = "3 seconds",
) -> StreamingQuery:
    """Tail the valid events and keep the first arrival per key.

    The default key takes two events of one customer in the same second for
    one; add ``event_id`` to tell them apart.
    """
    source = stream_parquet(spark, f"{root}/raw_data/events", schemas.CLEAN_EVENTS)
    return stream_to_parquet(
        dedup_stream(source, keys),
        f"{root}/output/fact_events_streaming",
        f"{root}/checkpoint_data/clean_fact_events_streaming",
        every=every,
    )


def stream_customer_events(
    spark: SparkSession,
    root: str,
    read_dim: Callable[[], DataFrame] | None = None,
    every: str | None = "3 seconds",
) -> StreamingQuery:
    """Tail the valid events, keep the first arrival of each event id and join
    the customer as the dimension has it in that micro-batch; an event of an
    unknown customer is dropped. Where nothing comes late or changes, this is the
    fact that ``build_fact_events`` makes."""
    source = stream_parquet(spark, f"{root}/raw_data/events", schemas.CLEAN_EVENTS)
    return stream_enriched(
        dedup_stream_by_id(source, ["event_id"]),
        read_dim or (lambda: read_dataset(spark, f"{root}/output/dim_customer")),
        "customer_id",
        ["name", "email", "country", "created_at"],
        f"{root}/output/customer_events_streaming",
        f"{root}/checkpoint_data/customer_events_streaming",
        how="inner",
        every=every,
    )


def read_customer_events(spark: SparkSession, root: str) -> DataFrame:
    return read_dataset(spark, f"{root}/output/customer_events_streaming").select(*FACT_COLUMNS)


def first_events(spark: SparkSession, root: str) -> DataFrame:
    """The raw events with the smallest ids."""
    return preview_rows(read_dataset(spark, f"{root}/raw_data/events"), by=["event_id"])


def check_events(spark: SparkSession, root: str) -> None:
    """Print the first raw events."""
    preview(first_events(spark, root))
