"""Split a load into clean rows and reject sets.

Rules shared by both splits:

* a row with a null in a required column (default: any column), or without a
  key, is incomplete and goes to the rejects
* ``scope="key"``: one incomplete row also removes the complete rows of its key
  from the clean set; ``"row"`` removes only itself
* a row without a key matches no key, so ``keep_null_keys=True`` leaves it in
  the clean set as well; by default it is only a reject
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.functions import any_null
from weirflow.operators.ranking import latest_by_key, rank_groups
from weirflow.operators.skew import HEAVY_ROWS
from weirflow.session import scratch_path, staged

RANK = "duplicate_regs"


class _Rules:
    """The predicates of one split."""

    def __init__(
        self, columns: Sequence[str], key: str, required: Sequence[str] | None, scope: str, keep: bool
    ) -> None:
        if scope not in ("key", "row"):
            raise ValueError(f"scope must be 'key' or 'row', not {scope!r}")
        self.key, self.scope = key, scope
        self.incomplete = any_null(
            dict.fromkeys([key, *(columns if required is None else required)])
        )
        self.keyless = F.col(f"`{key}`").isNull()
        # Rows that may be clean; those of tainted keys still have to go.
        self.candidate = ~self.incomplete | self.keyless if keep else ~self.incomplete

    def tainted_keys(self, df: DataFrame) -> DataFrame:
        # Distinct combines on the map side: a heavy key is one row per task.
        return df.where(self.incomplete & ~self.keyless).select(self.key).distinct()


class Incomplete(NamedTuple):
    clean: DataFrame
    invalid: DataFrame


def quarantine_incomplete(
    df: DataFrame,
    key: str,
    required: Sequence[str] | None = None,
    scope: str = "key",
    keep_null_keys: bool = False,
    stage: str | None = None,
) -> Incomplete:
    """Reject incomplete rows; copies of a key are all kept.

    The distinct tainted keys, one narrow column, are staged below ``stage``
    (default: the shared folder). Their size is then known: Spark broadcasts
    them, or splits a heavy key in the join.
    """
    rules = _Rules(df.columns, key, required, scope, keep_null_keys)
    clean = df.where(rules.candidate)
    if scope == "key":
        path = f"{stage}/tainted-{uuid.uuid4().hex}" if stage else scratch_path(df.sparkSession, "tainted")
        clean = _without_keys(clean, staged(rules.tainted_keys(df), path), key)
    return Incomplete(clean, df.where(rules.incomplete))


def _without_keys(df: DataFrame, tainted: DataFrame, key: str) -> DataFrame:
    return df.join(tainted, key, "left_anti").select(*df.columns)


class Quarantine:
    """Reject older copies of a key and incomplete rows.

    The newest copy of a key is clean, unless its key is tainted. With
    ``scope="row"`` complete copies rank before incomplete ones. An older copy
    that is also incomplete is in both reject sets.
    """

    def __init__(
        self,
        df: DataFrame,
        key: str,
        latest: Sequence[str],
        required: Sequence[str] | None = None,
        scope: str = "key",
        keep_null_keys: bool = False,
        heavy_rows: int = HEAVY_ROWS,
    ) -> None:
        self._df, self._key, self._latest, self._heavy_rows = df, key, latest, heavy_rows
        self._rules = _Rules(df.columns, key, required, scope, keep_null_keys)

    @property
    def clean(self) -> DataFrame:
        """The clean rows alone need no ranks: groups are cut to one row before
        the shuffle, and the tainted keys are joined in place after it."""
        newest = latest_by_key(self._df.where(self._rules.candidate), [self._key], self._latest)
        return self._untainted(newest, self._df)

    @cached_property
    def ranked(self) -> DataFrame:
        """All rows with their rank: the parent of both reject sets."""
        return rank_groups(
            self._df,
            [self._key],
            self._latest,
            RANK,
            first=[self._rules.incomplete.asc()] if self._rules.scope == "row" else (),
            heavy_rows=self._heavy_rows,
        )

    @property
    def duplicates(self) -> DataFrame:
        return self.ranked.where(F.col(RANK) > 1)

    @property
    def invalid(self) -> DataFrame:
        return self.ranked.where(self._rules.incomplete)

    @property
    def clean_of_ranked(self) -> DataFrame:
        """``clean`` out of ``ranked``, for a job that has persisted it."""
        newest = self.ranked.where((F.col(RANK) == 1) & self._rules.candidate)
        return self._untainted(newest.select(*self._df.columns), self.ranked)

    def _untainted(self, newest: DataFrame, source: DataFrame) -> DataFrame:
        if self._rules.scope == "row":
            return newest
        return _without_keys(newest, self._rules.tainted_keys(source), self._key)
