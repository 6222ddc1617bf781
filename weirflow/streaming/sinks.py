"""Checkpointed file sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` is a processing-time interval; None takes what is there and ends."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def stream_to_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = ("processing_date",),
    every: str | None = "2 seconds",
) -> StreamingQuery:
    """Append to a partitioned Parquet dataset, exactly once across restarts.

    One checkpoint directory belongs to one query. The sink's commit log lets
    another stream tail ``path`` without seeing uncommitted files.
    """
    writer = df.writeStream.format("parquet").outputMode("append").partitionBy(*by)
    return _triggered(
        writer.option("path", path).option("checkpointLocation", checkpoint), every
    ).start()


def await_all(*queries: StreamingQuery) -> None:
    """Wait until each query ends; a failed one raises."""
    for query in queries:
        query.awaitTermination()


def await_any(spark: SparkSession) -> None:
    """Wait until any query of the session ends."""
    spark.streams.awaitAnyTermination()
