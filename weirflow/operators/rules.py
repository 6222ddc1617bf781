"""Counts of broken rules, taken while a load is written, and limits on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weirflow.session import staged

ROWS = "rows"


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``broken`` (SQL, or a column) is true. More than
    ``most`` of all rows (a share) stop the load; None only counts."""

    name: str
    broken: str | Column
    most: float | None = None

    def column(self) -> Column:
        found = F.expr(self.broken) if isinstance(self.broken, str) else self.broken
        return F.coalesce(found, F.lit(False))


class BrokenRules(ValueError):
    """A load breaks a rule in too many rows."""

    def __init__(self, counts: dict[str, int], rules: Sequence[Rule]) -> None:
        self.counts = counts
        said = ", ".join(f"{r.name} in {counts[r.name]} of {counts[ROWS]} rows (at most {r.most:.2%})" for r in rules)
        super().__init__(f"broken rules: {said}")


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> list[Column]:
    """Aggregates: all rows, and those that break each rule."""
    names = [ROWS, *[rule.name for rule in rules]]
    if len(set(names)) < len(names):
        raise ValueError(f"rules need different names, and none is {ROWS!r}")
    broken = [F.count_if(rule.column()).alias(rule.name) for rule in rules]
    return [F.count(F.lit(1)).alias(ROWS), *broken]


def staged_with_counts(df: DataFrame, path: str, rules: Sequence[Rule]) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written to ``path`` and read back, and the counts of its rules, which
    the same pass takes. Raises ``BrokenRules`` where one is broken too often;
    whoever calls this before replacing anything leaves the old data as it is."""
    seen = Observation()
    again = staged(df.observe(seen, *rule_counts(df, rules)), path)
    counts = {name: int(n or 0) for name, n in seen.get.items()}
    exceeded = [r for r in rules if r.most is not None and counts[r.name] > r.most * counts[ROWS]]
    if exceeded:
        raise BrokenRules(counts, exceeded)
    return again, counts
