"""Deduplication with expiring state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Fixed value: how late an event may be.
ALLOWED_LATENESS = "10 minutes"


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str],
    event_time: str = "event_timestamp",
    lateness: str = ALLOWED_LATENESS,
) -> DataFrame:
    """Emit the first arrival per key and drop rows later than the watermark.

    The watermark trails the newest event time of the batches before by
    ``lateness``. ``event_time`` must be among the keys: only then does the
    watermark expire the state, which otherwise grows without end.
    """
    if event_time not in keys:
        raise ValueError(f"{event_time!r} must be one of the keys so that state expires")
    return df.withWatermark(event_time, lateness).dropDuplicates(list(keys))


def dedup_stream_by_id(
    df: DataFrame,
    ids: Sequence[str],
    event_time: str = "event_timestamp",
    lateness: str = ALLOWED_LATENESS,
) -> DataFrame:
    """Emit the first arrival of each id; its copies may have other event times.

    An id is known until the watermark has passed its event time by ``lateness``,
    and its copies have to come within that. State holds ids alone and expires.
    """
    return df.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(ids))
