"""Star join: fact rows with the attributes of their dimension row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    attributes: Sequence[str],
    how: str = "left",
    dim_key: str | None = None,
) -> DataFrame:
    """Join ``dim`` (one row per key) and append its ``attributes``.

    ``how="left"`` keeps facts without a dimension row, with null attributes;
    ``"inner"`` drops them. The dimension is cut to what is used and no hint is
    given: Spark broadcasts it when its measured size allows, and otherwise
    sort-merges, where AQE splits a heavy fact key over several tasks (to the
    dimension side it is one row). For that, pass a dimension that is read from
    a table: one still being computed on the same key would be joined in place,
    without an exchange that can be split.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    side = dim.select(
        F.col(f"`{dim_key or key}`").alias("_dim_key"), *[F.col(f"`{a}`") for a in attributes]
    )
    return fact.join(side, F.col(f"`{key}`") == F.col("_dim_key"), how).drop("_dim_key")
