"""What became of the rows of every micro-batch."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "query string, run string, batch long, watermark string, rows_in long, kept long, duplicates long, late long"
)


class Audit(StreamingQueryListener):
    """Appends one row for each micro-batch of the deduplicating streams of a
    session: rows that came in, and how many of them were kept, were duplicates,
    or came after the watermark had passed them.

    ::

        audit = Audit(spark, path)
        spark.streams.addListener(audit)
        ...
        audit.wait(query)
        spark.streams.removeListener(audit)
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._written: dict[str, int] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        states = [s for s in progress.stateOperators if s.operatorName.startswith("dedup")]
        if states:
            row = (
                str(progress.name or progress.id),
                str(progress.runId),
                progress.batchId,
                progress.eventTime.get("watermark"),
                progress.numInputRows,
                sum(s.numRowsUpdated for s in states),
                sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for s in states),
                sum(s.numRowsDroppedByWatermark for s in states),
            )
            self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        with self._changed:
            self._written[str(progress.runId)] = progress.batchId
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._written.pop(str(event.runId), None)
            self._changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until every batch that ``query`` has finished so far is written: what
        is told of a query arrives later than its results."""
        last, run = query.lastProgress, str(query.runId)
        done = last is None or self._reached(run, last.batchId, seconds)
        if not done:
            raise TimeoutError(f"batch {last.batchId} of {run} was not reported within {seconds} s")

    def _reached(self, run: str, batch: int, seconds: float) -> bool:
        with self._changed:
            return self._changed.wait_for(
                lambda: run in self._ended or self._written.get(run, -1) >= batch, timeout=seconds
            )
