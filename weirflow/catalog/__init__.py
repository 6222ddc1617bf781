"""Named queries over the driver tables, and the same results as plain SQL."""

from weirflow.catalog.oracle import ORACLE_SQL
from weirflow.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
