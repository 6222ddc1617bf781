"""DataFrame -> DataFrame operators."""

from weirflow.operators.quarantine import (
    Incomplete,
    Quarantine,
    quarantine_incomplete,
)
from weirflow.operators.ranking import latest_by_key, rank_groups
from weirflow.operators.skew import heavy_keys
from weirflow.operators.stamps import conform, stamp_date, stamp_reject
from weirflow.operators.star import enrich

__all__ = [
    "Incomplete",
    "Quarantine",
    "conform",
    "enrich",
    "heavy_keys",
    "latest_by_key",
    "quarantine_incomplete",
    "rank_groups",
    "stamp_date",
    "stamp_reject",
]
