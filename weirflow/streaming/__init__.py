"""Structured Streaming sources, operators and sinks."""

from weirflow.streaming.audit import Audit
from weirflow.streaming.compaction import Compaction
from weirflow.streaming.dedup import dedup_stream, dedup_stream_by_id
from weirflow.streaming.enrich import stream_enriched
from weirflow.streaming.sinks import await_all, await_any, stream_to_parquet
from weirflow.streaming.sources import stream_json, stream_parquet

__all__ = [
    "Audit",
    "Compaction",
    "await_all",
    "await_any",
    "dedup_stream",
    "dedup_stream_by_id",
    "stream_enriched",
    "stream_json",
    "stream_parquet",
    "stream_to_parquet",
]
