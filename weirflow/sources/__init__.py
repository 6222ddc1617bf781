"""Bounded sources. A missing path raises and stops the load."""

from weirflow.sources.files import (
    read_csv,
    read_dataset,
    read_json_array,
    read_json_lines,
    static_dim,
)
from weirflow.sources.evolution import IncompatibleSchema, SchemaRecord, read_evolved
from weirflow.sources.months import drop_schemas, month_spine, read_months

__all__ = [
    "IncompatibleSchema",
    "SchemaRecord",
    "drop_schemas",
    "month_spine",
    "read_csv",
    "read_dataset",
    "read_evolved",
    "read_json_array",
    "read_json_lines",
    "read_months",
    "static_dim",
]
