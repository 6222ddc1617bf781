"""Bounded sinks."""

from weirflow.sinks.files import (
    preview,
    preview_rows,
    replace_partitions,
    write_partitions,
    write_rejects,
    write_snapshot,
    write_table,
)
from weirflow.sinks.jdbc import write_jdbc
from weirflow.sinks.snapshot import KeyedSnapshot

__all__ = [
    "KeyedSnapshot",
    "preview",
    "preview_rows",
    "replace_partitions",
    "write_jdbc",
    "write_partitions",
    "write_rejects",
    "write_snapshot",
    "write_table",
]
