"""CSV, JSON array, Parquet and literal-row sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, raw_line: str | None = None
) -> DataFrame:
    """Comma-separated text with a header; an empty field is null.

    With a schema the header of every file is checked against it and the data
    is read once; a value that does not fit is null, and ``raw_line`` names a
    column that keeps the whole line of such a row. Without a schema the types
    are inferred by an extra pass.
    """
    reader = spark.read.option("header", True).option("sep", ",")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if raw_line is not None:
        schema = T.StructType([*schema.fields, T.StructField(raw_line, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", raw_line)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType | None = None, split: bool = False
) -> DataFrame:
    """JSON documents holding one array of objects each.

    Spark's multi-line reader takes a whole document in one task. ``split=True``,
    with a schema, cuts the text at closing braces instead, so that many tasks
    share a document. That needs flat objects without braces in their strings;
    documents of any other kind, which a first pass finds, and objects that do
    not parse are an error.
    """
    if not split:
        reader = spark.read.option("multiLine", True)
        return (reader if schema is None else reader.schema(schema)).json(path)
    if schema is None:
        raise ValueError("a document can only be cut with a schema")
    # Everything between two closing braces: separators, then one open object.
    cut = spark.read.option("lineSep", "}").text(path)
    piece = cut.select("value", F.col("_metadata.file_path").alias("file")).withColumn(
        "object", F.ltrim("value", F.lit(" \t\r\n,[]"))
    )
    if not _cut_at_objects(piece):
        raise ValueError(f"{path}: not arrays of flat objects without braces in their strings")
    closed = F.concat("object", F.lit("}"))
    rows = piece.where("object != ''")
    parsed = rows.select(F.from_json(closed, schema, {"mode": "FAILFAST"}).alias("row"))
    return parsed.select("row.*")


def _cut_at_objects(piece: DataFrame) -> bool:
    """Whether every piece is one complete object, and every file ends its
    array. A cut inside a string leaves an odd number of quotes."""
    escaped = F.contains("object", F.lit("\\"))
    plain = F.when(escaped, F.regexp_replace("object", r"\\.", "")).otherwise(F.col("object"))

    def count(mark: str) -> Column:
        return F.length(plain) - F.length(F.translate(plain, mark, ""))

    whole = (count('"') % 2 == 0) & (count("{") == 1) & F.startswith("object", F.lit("{"))
    checks = piece.groupBy("file").agg(
        F.bool_and((F.col("object") == "") | whole).alias("whole"),
        F.bool_or((F.col("object") == "") & F.contains("value", F.lit("]"))).alias("ended"),
    )
    return checks.where(~(F.col("whole") & F.col("ended"))).isEmpty()


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_dataset(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    dates: Iterable[str | dt.date] | None = None,
) -> DataFrame:
    """A Parquet dataset with its partition columns.

    ``dates`` keeps those ``processing_date`` partitions; the others are not
    even listed as input of the scan.
    """
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if dates is not None:
        wanted = [F.lit(str(d)).cast("date") for d in dates]
        df = df.where(F.col("processing_date").isin(*wanted))
    return df


def static_dim(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A dimension given as literal rows. Spark knows the size of a local table, so
    that joins broadcast it instead of bringing the facts of a key together."""
    checked = spark.createDataFrame(rows, schema)
    return spark.createDataFrame(checked.toArrow(), schema)
