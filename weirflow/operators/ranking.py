"""Newest-first ranking inside key groups, safe against heavy keys.

``latest_by_key`` needs rank 1 only. Catalyst turns ``row_number() = 1`` into
a group limit on both sides of the shuffle, so each map task sends at most one
row per key and no key can be heavy after the exchange.

``rank_groups`` needs every rank, so that limit does not apply and a plain
window would put a whole group into one task. Groups of at least ``heavy_rows``
rows are therefore ranked by a distributed sort instead; the rest share one
window, hence one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators.skew import HEAVY_ROWS, KEY_HASH, heavy_keys
from weirflow.session import cut_lineage

def _newest_first(
    df: DataFrame, keys: Sequence[str], latest: Sequence[str], ties: Sequence[str] | None
) -> list[Column]:
    """Descending sort keys. By default every further column breaks ties, so
    that the survivor does not depend on the order in which rows arrive."""
    if ties is None:
        fields = [f for f in df.schema.fields if f.name not in {*keys, *latest}]
        ties = [f.name for f in fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [F.col(f"`{name}`").desc_nulls_last() for name in [*latest, *ties]]


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key: largest ``latest`` columns, then ``ties``."""
    newest = Window.partitionBy(*keys).orderBy(*_newest_first(df, keys, latest, ties))
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def rank_groups(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str],
    rank: str,
    first: Sequence[Column] = (),
    ties: Sequence[str] | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add ``rank``, 1 for the newest row of its key (bigint: a heavy group may
    outgrow int). ``first`` are sort keys that go before ``latest``."""
    order = [*first, *_newest_first(df, keys, latest, ties)]
    heavy = heavy_keys(df, keys, heavy_rows)
    if heavy.isEmpty():
        return _rank_by_window(df, keys, order, rank)
    # Spark broadcasts the heavy keys by their size, or splits them in the join.
    hashed = df.withColumn(KEY_HASH, F.xxhash64(*keys))
    light, rest = (
        hashed.join(heavy, KEY_HASH, how).select(*[F.col(f"`{name}`") for name in df.columns])
        for how in ("left_anti", "left_semi")
    )
    light = _rank_by_window(light, keys, order, rank)
    return light.unionByName(_rank_by_sort(rest, keys, order, rank))


def _rank_by_window(
    df: DataFrame, keys: Sequence[str], order: list[Column], rank: str
) -> DataFrame:
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(newest).cast("long"))


def _rank_by_sort(df: DataFrame, keys: Sequence[str], order: list[Column], rank: str) -> DataFrame:
    """Ranks from positions in a global sort.

    Range partitioning spreads one key over many tasks; ``_copy`` does the same
    for rows that are equal in every column. A key's rows inside one sort
    partition have consecutive positions, so a rank is the distance to the
    first of them plus the rows of that key in earlier partitions. Both inputs
    of the sum are checkpointed: neither the copy numbers nor the partition
    bounds may change if a task is run again.
    """
    numbered = cut_lineage(df.withColumn("_copy", F.monotonically_increasing_id()))
    ordered = cut_lineage(
        numbered.orderBy(*keys, *order, "_copy").withColumn(
            "_position", F.monotonically_increasing_id()
        )
    )
    # The upper bits of the id are the partition number.
    ordered = ordered.withColumn("_slice", F.shiftright("_position", 33))
    runs = ordered.groupBy("_slice", *keys).agg(
        F.min("_position").alias("_start"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    run_keys = {name: f"_run_{i}" for i, name in enumerate(keys)}
    runs = runs.select(
        F.col("_slice").alias("_run_slice"),
        *[F.col(f"`{name}`").alias(alias) for name, alias in run_keys.items()],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_start") + 1).alias("_shift"),
    )
    same_run = F.col("_slice") == F.col("_run_slice")
    for name, alias in run_keys.items():
        same_run = same_run & F.col(f"`{name}`").eqNullSafe(F.col(alias))
    # One run per heavy key plus one per sort partition border.
    return ordered.join(runs, same_run).select(
        *[F.col(f"`{name}`") for name in df.columns],
        (F.col("_position") + F.col("_shift")).alias(rank),
    )
