"""All versions of a dimension row, and facts with the version of their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.operators.skew import HEAVY_ROWS, KEY_HASH, heavy_keys

VALID_FROM, VALID_TO = "valid_from", "valid_to"
# Width of a stretch of time that a heavy key is cut into.
BUCKET_DAYS = 30
_BUCKET, _HEAVY = "_bucket", "_heavy"


def versions(
    loads: DataFrame, keys: Sequence[str], attributes: Sequence[str], since: str = "processing_date"
) -> DataFrame:
    """The states a key went through: ``keys``, ``attributes``, ``valid_from`` and
    ``valid_to`` (not included; null for the newest).

    ``loads`` has at most one row for each key and ``since``. Loads that change
    no attribute start no version, and a key that a load does not mention stays
    as it is. Rows without a key or a time are left out. One shuffle, in which
    a key has as many rows as there are loads.
    """
    known = loads.dropna(subset=[*keys, since])
    order = Window.partitionBy(*keys).orderBy(since)
    state = F.struct(*[F.col(f"`{name}`") for name in attributes])
    changed = known.withColumn("_changed", ~state.eqNullSafe(F.lag(state).over(order))).where("_changed")
    return changed.withColumn(VALID_TO, F.lead(since).over(order)).select(
        *[F.col(f"`{name}`") for name in [*keys, *attributes]], F.col(f"`{since}`").alias(VALID_FROM), VALID_TO
    )


def enrich_as_of(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    at: str,
    attributes: Sequence[str],
    how: str = "left",
    heavy_rows: int = HEAVY_ROWS,
    bucket_days: int = BUCKET_DAYS,
) -> DataFrame:
    """Append the ``attributes`` that the version of a fact's key had at time ``at``.

    ``dim`` has the columns of ``versions``. ``how="left"`` keeps facts without a
    version then, or without a key or time, with null attributes; ``"inner"``
    drops them. No other column of a fact may be called like an attribute.

    Facts and versions meet by key. A key of at least ``heavy_rows`` facts is cut
    into stretches of ``bucket_days`` as well, so that it is no single task and
    its facts are compared with the versions of their time only; just the
    versions of these keys are repeated, once for each stretch they are valid in
    and facts exist for. Facts that cannot match are spread by their content.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    clash = set(attributes) & set(facts.columns)
    if clash:
        raise ValueError(f"facts have columns called like attributes: {sorted(clash)}")
    names = {f"_key_{i}": key for i, key in enumerate(keys)}
    side = dim.select(
        *[F.col(f"`{key}`").alias(name) for name, key in names.items()],
        *[F.col(f"`{name}`").alias(f"_dim_{name}") for name in attributes],
        F.col(VALID_FROM).alias("_from"),
        F.col(VALID_TO).alias("_to"),
    )
    time = F.col(f"`{at}`")
    key_columns = [F.col(f"`{key}`") for key in keys]
    matchable = time.isNotNull()
    for column in key_columns:
        matchable = matchable & column.isNotNull()
    spread = -1 - F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in facts.columns]), F.lit(1024))

    heavy = heavy_keys(facts.where(matchable), keys, heavy_rows)
    if heavy.isEmpty():
        facts = facts.withColumn(_BUCKET, F.when(matchable, F.lit(0).cast("long")).otherwise(spread))
        side = side.withColumn(_BUCKET, F.lit(0).cast("long"))
    else:
        marked = heavy.withColumn(_HEAVY, F.lit(True))
        mine = _with_mark(facts, marked, key_columns)
        bucket = F.when(F.col(_HEAVY), _stretch(time, bucket_days)).otherwise(F.lit(0))
        facts = mine.withColumn(_BUCKET, F.when(matchable, bucket).otherwise(spread)).drop(_HEAVY)
        # One row: where the facts of heavy keys begin and end.
        ends = mine.where(F.col(_HEAVY)).agg(
            F.min(_stretch(time, bucket_days)).alias("lo"), F.max(_stretch(time, bucket_days)).alias("hi")
        ).first()
        lo = F.greatest(_stretch(F.col("_from"), bucket_days), F.lit(ends["lo"]))
        hi = F.least(_stretch(F.col("_to"), bucket_days), F.lit(ends["hi"]))
        valid_in = F.when(lo <= hi, F.sequence(lo, hi))
        side = _with_mark(side, marked, [F.col(name) for name in names])
        light = F.array(F.lit(0).cast("long"))
        buckets = F.when(F.col(_HEAVY), valid_in).otherwise(light)
        side = side.withColumn("_in", F.explode(buckets)).drop(_HEAVY)
        side = side.withColumnRenamed("_in", _BUCKET)
    side = side.withColumnRenamed(_BUCKET, "_dim_bucket")
    same = (F.col(_BUCKET) == F.col("_dim_bucket")) & (time >= F.col("_from"))
    same = same & (F.col("_to").isNull() | (time < F.col("_to")))
    for name, key in names.items():
        same = same & (F.col(f"`{key}`") == F.col(name))
    kept = [F.col(f"`{name}`") for name in facts.columns if name != _BUCKET]
    return facts.join(side, same, how).select(
        *kept, *[F.col(f"`_dim_{name}`").alias(name) for name in attributes], F.col("_from").alias(VALID_FROM)
    )


def _with_mark(df: DataFrame, heavy: DataFrame, key_columns: list[Column]) -> DataFrame:
    """Mark rows of heavy keys; Spark broadcasts these by their size."""
    hashed = df.withColumn(KEY_HASH, F.xxhash64(*key_columns))
    return hashed.join(heavy, KEY_HASH, "left").drop(KEY_HASH)


def _stretch(time: Column, days: int) -> Column:
    """The number of the stretch of time; null (an open end) counts as no bound."""
    return F.floor(F.unix_date(time.cast("date")) / days).cast("long")
