"""Finding the keys that are too heavy to share one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.session import scratch_path, staged

# A group below this size is cheap for one task to sort and spill.
HEAVY_ROWS = 1_000_000
KEY_HASH = "_key_hash"


def heavy_keys(df: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """The hashes (KEY_HASH) of all keys that hold at least ``heavy_rows`` rows
    of ``df``; staged, unless there are none, as for most tables.

    One pass over the key columns with a count that is combined before the
    shuffle. There are at most rows / ``heavy_rows`` heavy keys. Null keys count
    like any other. A light key can only join them by sharing a hash, which
    changes how it is processed and never the result.
    """
    hashes = df.select(F.xxhash64(*keys).alias(KEY_HASH))
    counts = hashes.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("rows"))
    heavy = counts.where(F.col("rows") >= heavy_rows).select(KEY_HASH).persist()
    try:
        if heavy.isEmpty():
            return df.sparkSession.createDataFrame([], heavy.schema)
        return staged(heavy, scratch_path(df.sparkSession, "heavy-keys"))
    finally:
        heavy.unpersist()
