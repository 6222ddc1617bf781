"""Monthly drops: one folder and file per month."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators.stamps import conform, resolve_process_date

SOURCE_MONTH = "source_month"


def month_spine(start: str | dt.date | None = None, end: str | dt.date | None = None) -> list[str]:
    """All months from start's to end's as ``YYYY-MM``, whatever the days are.
    Either end defaults to today."""
    first, last = resolve_process_date(start), resolve_process_date(end)
    numbers = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in numbers]


def drop_schemas(spark: SparkSession, layout: str, months: Sequence[str]) -> dict[str, T.StructType]:
    """The schema of each monthly drop, from a footer of it."""
    return {month: spark.read.parquet(layout.format(month=month)).schema for month in months}


def read_months(
    spark: SparkSession,
    layout: str,
    months: Sequence[str],
    schema: T.StructType | None = None,
    as_came: Mapping[str, T.StructType] | None = None,
) -> DataFrame:
    """The monthly drops as one table, with ``source_month`` naming the drop.
    ``layout`` is a drop's path with ``{month}`` in it; every month must exist.

    One scan reads all drops. Without a schema all files must agree on types.
    With one the drops are cast to it, so months may differ in width and in
    columns; that takes one scan for each distinct schema, not for each month.
    ``as_came`` has the schemas of the drops, if they are known.
    """
    if not months:
        raise ValueError("no months to read")
    if schema is None:
        return _scan(spark, layout, months)
    as_came = as_came or drop_schemas(spark, layout, months)
    generations: dict[str, list[str]] = {}
    for month in months:
        generations.setdefault(as_came[month].json(), []).append(month)
    named = T.StructType([*schema.fields, T.StructField(SOURCE_MONTH, T.StringType())])
    return reduce(DataFrame.unionAll, [conform(_scan(spark, layout, some), named) for some in generations.values()])


def _scan(spark: SparkSession, layout: str, months: Sequence[str]) -> DataFrame:
    drops = spark.read.parquet(*[layout.format(month=month) for month in months])
    # The last part of the path that has a month in it, as it is written in file names.
    part = [part for part in layout.split("/") if "{month}" in part][-1]
    example = spark._jvm.org.apache.hadoop.fs.Path("/" + part.format(month="0000-00")).toUri().toString()
    pattern = "^.*" + re.escape(example).replace(re.escape("0000-00"), r"(\d{4}-\d{2})") + "(?:/|$)"
    return drops.withColumn(SOURCE_MONTH, F.regexp_extract("_metadata.file_path", pattern, 1))
