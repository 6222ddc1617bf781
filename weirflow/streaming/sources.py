"""File streams with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader


def _reader(spark: SparkSession, schema: T.StructType, max_bytes: int | None) -> DataStreamReader:
    reader = spark.readStream.schema(schema)
    # Bounds a micro-batch when a long backlog is read. Not for streams with a
    # watermark: it would advance inside the backlog and make rows late.
    return reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader


def stream_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_bytes: int | None = None,
    raw_line: str | None = None,
) -> DataFrame:
    """JSON lines as they arrive; a line that does not parse is a row of nulls.
    ``raw_line`` names a column that keeps the text of such lines."""
    if raw_line is not None:
        schema = T.StructType([*schema.fields, T.StructField(raw_line, T.StringType())])
    reader = _reader(spark, schema, max_bytes)
    if raw_line is not None:
        reader = reader.option("columnNameOfCorruptRecord", raw_line)
    return reader.json(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, max_bytes: int | None = None
) -> DataFrame:
    """Parquet files as they arrive. Name partition columns in the schema, so
    that the stream also starts while the directory is still empty."""
    return _reader(spark, schema, max_bytes).parquet(path)
