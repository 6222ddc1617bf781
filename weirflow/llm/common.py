"""Helpers shared by the operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from weirflow.session import scratch_path

# Functions of these modules travel with the tasks that run them, so that
# executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules["weirflow.llm"])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage through a committed table: later stages read the same
    rows however often they run, and survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores behind it until no column of ``frames`` has it."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
