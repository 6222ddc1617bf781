"""A report kept in key-hash partitions, of which a merge replaces a few.

Every merge writes the partitions it changes into a new folder and then commits
by creating one small numbered file, which says for every partition which folder
holds it. Readers see the state before the merge or the one after it, and one
that has started goes on reading the files it began with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.commits import CommitLog

BUCKETS = 32
_BUCKET = "_bucket"


class KeyedSnapshot:
    """One row (or some rows) for each key, spread over ``buckets`` by its hash."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._log = CommitLog(spark, f"{self.path}/_states")

    def bucket(self, *columns: str) -> Column:
        """The partition of a row, by its keys or by other columns that hold them."""
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns or self.keys]), F.lit(self.buckets)).cast("int")

    # --- states -------------------------------------------------------------

    def version(self) -> int:
        """The number of the last commit; 0 before the first."""
        return self._log.last()

    def _state(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"folders": {}, "loads": [], "facts": {}, "schema": None}
        return self._log.read(version)

    def loads(self) -> set[str]:
        """What has been merged."""
        return set(self._state()["loads"])

    def facts(self) -> dict:
        """What the last commit noted about itself."""
        return self._state()["facts"]

    def changed_buckets(self, since: int) -> list[int]:
        """The partitions that are not what they were in an earlier version."""
        before, now = self._state(since)["folders"], self._state()["folders"]
        return sorted(int(k) for k in before.keys() | now.keys() if before.get(k) != now.get(k))

    # --- rows ---------------------------------------------------------------

    def read(self, buckets: Iterable[int] | None = None, version: int | None = None) -> DataFrame | None:
        """The rows, or those of some partitions: the files of others are not
        listed. None before the first commit."""
        state = self._state(version)
        if state["schema"] is None:
            return None
        schema = T.StructType.fromJson(state["schema"])
        wanted = state["folders"] if buckets is None else {str(b) for b in buckets}
        paths = [
            f"{self.path}/data/{folder}/{_BUCKET}={bucket}"
            for bucket, folder in sorted(state["folders"].items(), key=lambda item: int(item[0]))
            if bucket in wanted
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def replace(self, df: DataFrame, buckets: Iterable[int], load: str, **facts: object) -> None:
        """Let ``buckets`` hold exactly the rows of ``df``, and note ``load`` and
        ``facts``. A row of another partition fails the write."""
        before, version = self._state(), self.version()
        owned = {int(b) for b in buckets}
        folder = uuid.uuid4().hex
        other = F.raise_error(F.lit("a row belongs to no partition of this merge")).cast("int")
        bucket = F.when(self.bucket().isin(*owned), self.bucket()).otherwise(other) if owned else other
        target = f"{self.path}/data/{folder}"
        rows = df.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET)
        rows.write.partitionBy(_BUCKET).parquet(target)
        # At most one folder per partition.
        names = [status.getPath().getName() for status in self._fs.listStatus(self._paths(target))]
        filled = {name.partition("=")[2] for name in names if name.startswith(f"{_BUCKET}=")}
        kept = {k: f for k, f in before["folders"].items() if int(k) not in owned}
        self._commit(
            version + 1,
            {
                "folders": {**kept, **{k: folder for k in filled}},
                "loads": sorted({*before["loads"], load}),
                "facts": facts,
                "schema": json.loads(df.schema.json()),
            },
        )

    def _commit(self, version: int, state: dict) -> None:
        """One of two merges that run at the same time fails here."""
        self._log.commit(version, state)

    def vacuum(self, keep: int = 2) -> None:
        """Remove the files that the last ``keep`` versions do not use."""
        versions = self._log.versions()
        used = {f for v in versions[-keep:] for f in self._state(v)["folders"].values()}
        data = self._paths(f"{self.path}/data")
        for status in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if status.getPath().getName() not in used:
                self._fs.delete(status.getPath(), True)
        for version in versions[:-keep]:
            self._log.remove(version)
