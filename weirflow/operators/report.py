"""Aggregated reports from partials that loads leave behind.

A load aggregates itself once, to one row for each combination of the finest
dimensions. Reports with subtotals then read partials only, whatever the number
of rows they stand for; a day that is loaded again replaces its own partials.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How partials of a measure become one.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "distinct": F.hll_union_agg}


def _taken(kind: str, column: str) -> Column:
    if kind == "count":
        return F.count(F.col(column))
    if kind == "distinct":
        return F.hll_sketch_agg(F.col(column))
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](F.col(column))


def partials(df: DataFrame, by: Sequence[str], measures: dict[str, tuple[str, str]]) -> DataFrame:
    """One row for each combination of ``by``. ``measures`` maps a name to a kind
    of MERGES and a column; ``distinct`` keeps a sketch. Sums should be of
    decimals or integers: only these do not depend on the order of rows."""
    unknown = {kind for kind, _ in measures.values()} - MERGES.keys()
    if unknown:
        raise ValueError(f"no measure of kind {sorted(unknown)}")
    return df.groupBy(*by).agg(*[_taken(kind, column).alias(name) for name, (kind, column) in measures.items()])


def report(
    parts: DataFrame,
    by: Sequence[str],
    measures: dict[str, tuple[str, str]],
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """``by``, the measures, and ``level``: one row for each combination in each of
    the grouping sets. Without ``sets`` a rollup: from all of ``by`` to the total.

    ``level`` has a bit for each of ``by``, the last one lowest, that is set where
    the row sums over it, as a null may also be a value.
    """
    if sets is None:
        sets = [by[:n] for n in range(len(by), -1, -1)]
    columns = [[F.col(c) for c in chosen] for chosen in sets]
    merged = []
    for name, (kind, _) in measures.items():
        total = MERGES[kind](name)
        merged.append((F.hll_sketch_estimate(total) if kind == "distinct" else total).alias(name))
    grouped = parts.groupingSets(columns, *by)
    return grouped.agg(*merged, F.grouping_id(*by).cast("long").alias("level"))
