"""Closed dates of a streamed dataset in few large files.

A stream writes a file for each partition of each micro-batch. Those files stay
where they are: the sink's commit log names them, and streams that tail the
dataset may not have read them yet. A compaction writes the rows of dates that
are over to a place of its own, and one small numbered file says which dates it
holds; ``read`` takes these from there and all others from the sink.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.commits import CommitLog

_RUN = "_compaction"


class Compaction:
    """The dataset that a stream appends to below ``path``, partitioned by ``by``,
    whose first column is a date; its compacted dates lie below ``target``.

    Readers see the state before a compaction or the one after it. A date that
    gets further files afterwards, as from a batch that began before midnight, is
    read from the sink until it is compacted again. A sink that forgets files
    (its ``retention``) has to keep them for longer than a date can get new ones.
    Rows without a date are never compacted.
    """

    def __init__(
        self, spark: SparkSession, path: str, target: str, by: Sequence[str] = ("processing_date",)
    ) -> None:
        self.spark, self.path, self.target, self.by = spark, path.rstrip("/"), target.rstrip("/"), list(by)
        self._log = CommitLog(spark, f"{self.target}/_states")

    def _state(self) -> dict:
        version = self._log.last()
        return self._log.read(version) if version else {"dates": {}, "schema": None}

    def _files(self, df: DataFrame) -> Counter[str]:
        """Files of each date among those that ``df`` was planned with."""
        date = re.compile(f"/{re.escape(self.by[0])}=([^/]+)/")
        return Counter(found[1] for found in map(date.search, df.inputFiles()) if found)

    def _covered(self, state: dict, files: Counter[str]) -> list[str]:
        """Compacted dates without newer files."""
        return sorted(d for d, kept in state["dates"].items() if files[d] <= kept["files"])

    def compact(self, before: dt.date) -> list[str]:
        """Compact the dates before ``before`` that are not compacted yet or have
        new files; returns them. One scan, one shuffle that splits large dates
        and gathers small ones; other dates are not read."""
        version, state = self._log.last(), self._state()
        streamed = self.spark.read.parquet(self.path)
        files = self._files(streamed)
        covered = set(self._covered(state, files))
        dates = sorted(d for d in files if d < before.isoformat() and d not in covered)
        if not dates:
            return []
        run = uuid.uuid4().hex
        rows = streamed.where(F.col(self.by[0]).isin(*[dt.date.fromisoformat(d) for d in dates]))
        rows.hint("rebalance", *self.by).write.partitionBy(*self.by).parquet(f"{self.target}/data/{_RUN}={run}")
        new = {d: {"run": run, "files": files[d]} for d in dates}
        # One of two compactions that run at the same time fails here.
        self._log.commit(
            version + 1, {"dates": {**state["dates"], **new}, "schema": json.loads(streamed.schema.json())}
        )
        return dates

    def read(self) -> DataFrame:
        """All rows of the dataset, those of compacted dates from their files."""
        state, streamed = self._state(), self.spark.read.parquet(self.path)
        covered = self._covered(state, self._files(streamed))
        if not covered:
            return streamed
        schema = T.StructType.fromJson(state["schema"]).add(_RUN, T.StringType())
        paths = [f"{self.target}/data/{_RUN}={state['dates'][d]['run']}/{self.by[0]}={d}" for d in covered]
        # The dates of all runs are one scan.
        reader = self.spark.read.schema(schema).option("basePath", f"{self.target}/data")
        elsewhere = F.col(self.by[0]).isin(*[dt.date.fromisoformat(d) for d in covered])
        rest = streamed.where(~F.coalesce(elsewhere, F.lit(False)))
        return rest.unionByName(reader.parquet(*paths).select(*streamed.columns))

    def vacuum(self, keep: int = 2) -> None:
        """Remove the files that the last ``keep`` states do not use."""
        versions = self._log.versions()
        used = {d["run"] for v in versions[-keep:] for d in self._log.read(v)["dates"].values()}
        paths = self.spark._jvm.org.apache.hadoop.fs.Path
        data = paths(f"{self.target}/data")
        fs = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(data) if fs.exists(data) else []:
            if status.getPath().getName().partition("=")[2] not in used:
                fs.delete(status.getPath(), True)
        for version in versions[:-keep]:
            self._log.remove(version)
