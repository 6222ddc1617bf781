"""Streams joined to a table as it is at each micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.operators import enrich
from weirflow.streaming.sinks import _triggered

BATCH = "batch_id"


def stream_enriched(
    df: DataFrame,
    read_dim: Callable[[], DataFrame],
    key: str,
    attributes: Sequence[str],
    path: str,
    checkpoint: str,
    how: str = "left",
    every: str | None = "2 seconds",
) -> StreamingQuery:
    """Append ``df`` with the attributes that ``read_dim`` gives when its batch
    runs; a row keeps the attributes of its time.

    A join with a table that is opened once goes on reading the files it had
    then, so every batch opens it anew. A batch owns the partition with its
    number and replaces it, so one that is run again after a failure leaves
    nothing twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        # An empty batch leaves no folder.
        joined = enrich(batch, read_dim(), key, attributes, how).withColumn(BATCH, F.lit(number))
        writer = joined.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH).parquet(path)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()
