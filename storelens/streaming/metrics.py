"""Counts of streams as stored rows.

A listener takes what a query reports of each micro-batch: its observed metrics (what it removes, drops or can't
decode) and the rows that came behind the watermark and were dropped by its state. They are stored as rows
(``name, metric, value``) in a folder per query and batch, so that counts are read like any other table and a
report that comes twice is stored once.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sinks.folders import write_batch

STATE, LATE = "state", "late_rows"
ROWS = "name string, metric string, value bigint"


def metric_rows(progress) -> list[tuple[str, str, int]]:
    """Rows of a progress report; metrics without a value are 0."""
    rows = [(name, metric, int(value or 0)) for name, metrics in progress.observedMetrics.items()
            for metric, value in metrics.asDict().items()]
    if progress.stateOperators:
        rows.append((STATE, LATE, sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)))
    return rows


class MetricRows(StreamingQueryListener):
    """Stores the counts of the queries of a session under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = metric_rows(progress)
        if rows:
            write_batch(self.spark.createDataFrame(rows, ROWS).coalesce(1), self.path, progress.batchId, str(progress.id))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def finish(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Waits for the end of the query and until all that it has reported is stored."""
        query.awaitTermination()
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no report of the end of {query.runId}")
            time.sleep(0.05)


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """``query, batch_id, name, metric, value`` of all reports."""
    return spark.read.parquet(path)
