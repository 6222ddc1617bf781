"""File sinks with an explicit overwrite rule per write.

* a dated or monthly load owns some partitions: ``replace_partitions``
* a report holds the full result: ``write_snapshot``, which leaves no stale
  partition behind when rows move to a newer date
* ``write_partitions`` is the plain dynamic overwrite underneath
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    writer = df.write.format(fmt).mode("overwrite")
    return writer.option("header", True) if fmt == "csv" else writer


def _rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring each partition value together before the write.

    After a shuffle on another key every task holds every partition value, and
    would write one small file per value. AQE sizes the result: it splits a
    heavy value over several tasks and merges small ones.
    """
    return df.hint("rebalance", *by)


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", rebalance: bool = False
) -> None:
    """Overwrite only the partitions that occur in ``df``."""
    if rebalance:
        df = _rebalanced(df, by)
    _writer(df, fmt).option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    values: Sequence[dict[str, object]],
    fmt: str = "parquet",
    rebalance: bool = False,
) -> None:
    """Make the given partitions hold exactly the rows of ``df``. A row of any
    other partition fails the write before anything is replaced.

    Dynamic overwrite leaves a partition alone when no row falls into it, so a
    reload without rejects would keep the rejects of the run before. The write
    itself observes which partitions it filled; the others are emptied.
    """
    by = list(values[0])
    df = _only_partitions(df, by, values)
    filled = Observation()
    # At most one entry per given partition reaches the driver.
    seen = F.collect_set(F.struct(*[F.col(f"`{name}`") for name in by])).alias("filled")
    write_partitions(df.observe(filled, seen), path, by, fmt, rebalance)
    done = {tuple(row) for row in filled.get["filled"]}
    for value in values:
        if tuple(value.values()) not in done:
            folder = "/".join(f"{name}={part}" for name, part in value.items())
            _writer(df.limit(0).drop(*by), fmt).save(f"{path}/{folder}")


def _only_partitions(
    df: DataFrame, by: Sequence[str], values: Sequence[dict[str, object]]
) -> DataFrame:
    owned = F.lit(False)
    for value in values:
        same = F.lit(True)
        for name, part in value.items():
            same = same & F.col(f"`{name}`").eqNullSafe(F.lit(part).cast(df.schema[name].dataType))
        owned = owned | same
    first = by[0]
    foreign = F.raise_error(
        F.concat(F.lit("a row belongs to no partition of this load: "), F.to_json(F.struct(*by)))
    )
    checked = F.when(owned, F.col(f"`{first}`")).otherwise(foreign.cast(df.schema[first].dataType))
    return df.withColumn(first, checked)


def write_snapshot(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", rebalance: bool = True
) -> None:
    """Replace the whole dataset, whatever partitions it held."""
    if rebalance:
        df = _rebalanced(df, by)
    _writer(df, fmt).option("partitionOverwriteMode", "static").partitionBy(*by).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace an unpartitioned dataset."""
    _writer(df, fmt).save(path)


def write_rejects(df: DataFrame, path: str, process_date: dt.date) -> None:
    """The load date's rejects as CSV with a header.

    CSV is for people to read: null and an empty field look alike in it.
    """
    replace_partitions(df, path, [{"processing_date": process_date}], fmt="csv")


def preview_rows(df: DataFrame, rows: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The first rows; with ``by``, in that order."""
    return (df.orderBy(*by) if by else df).limit(rows)


def preview(df: DataFrame, rows: int = 20) -> None:
    """Print the first rows, long values cut."""
    df.show(rows)
