"""Merging one load into a report of the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.ranking import latest_by_key
from weirflow.sinks.snapshot import KeyedSnapshot


def _same_keys(snapshot: KeyedSnapshot, other: DataFrame) -> tuple[DataFrame, Column]:
    names = {key: f"_key_{i}" for i, key in enumerate(snapshot.keys)}
    side = other.select(*[F.col(f"`{key}`").alias(name) for key, name in names.items()])
    same = F.lit(True)
    for key, name in names.items():
        same = same & F.col(f"`{key}`").eqNullSafe(F.col(name))
    return side, same


def merge_latest(
    snapshot: KeyedSnapshot,
    history: DataFrame,
    date: str,
    latest: Sequence[str],
    date_column: str = "processing_date",
) -> list[int]:
    """Merge the load of ``date`` from ``history`` (all loads) and return the
    partitions that were replaced.

    A load that is new reads itself and the partitions its keys are in. One
    that has been merged before may have been corrected since: keys of which the
    report shows a row of it get their newest row from the history again, of
    which only these keys are shuffled. In both cases the report is what a full
    rebuild from the merged loads would give.
    """
    load = history.where(F.col(date_column) == F.lit(date).cast("date"))
    merged = snapshot.loads()
    if date in merged:
        # Only loads that have been merged belong to the report.
        known = history.where(F.col(date_column).isin(*[F.lit(d).cast("date") for d in sorted(merged)]))
        before = snapshot.read()
        keys = [F.col(f"`{key}`") for key in snapshot.keys]
        stale = before.where(F.col(date_column) == F.lit(date).cast("date")).select(*keys)
        affected = load.select(*keys).unionByName(stale).distinct()
        buckets = _buckets(snapshot, affected)
        side, same = _same_keys(snapshot, affected)
        again = latest_by_key(known.join(side, same, "left_semi"), snapshot.keys, latest)
        rows = snapshot.read(buckets).join(side, same, "left_anti").unionByName(again)
    else:
        buckets = _buckets(snapshot, load)
        before = snapshot.read(buckets)
        rows = load if before is None else before.unionByName(load)
        rows = latest_by_key(rows, snapshot.keys, latest)
    snapshot.replace(rows, buckets, date)
    return buckets


def _buckets(snapshot: KeyedSnapshot, rows: DataFrame) -> list[int]:
    """At most as many as the snapshot has."""
    return sorted(row[0] for row in rows.select(snapshot.bucket()).distinct().collect())
