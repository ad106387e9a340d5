"""Progress of streaming queries, kept as a table.

Spark remembers a query's last hundred reports. A :class:`ProgressLog` writes every report
as it comes, so that totals hold over any number of batches and restarts.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

REPORT = ("query_id string, run_id string, query string, batch_id long, reported_at timestamp, input_rows long, "
          "rows_per_second double, late_rows long, state_rows long, duration_ms long")


class ProgressLog(StreamingQueryListener):
    """Listener that appends reports to the table at ``path``; a context in which it is active.

    ``every`` reports are written together, and the rest when their query ends. A driver that
    dies loses the reports not yet written, ``every - 1`` at most.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 1):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.lock = threading.Lock()
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self._write()

    def onQueryStarted(self, event) -> None:
        self._ending(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        held = sum(s.numRowsTotal for s in p.stateOperators)
        with self.lock:
            self.rows.append((str(p.id), str(p.runId), p.name, p.batchId, at, p.numInputRows, p.processedRowsPerSecond,
                              late, held, p.batchDuration))
            full = len(self.rows) >= self.every
        if full:
            self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._write()
        self._ending(str(event.runId)).set()

    def wait(self, queries: list[StreamingQuery], seconds: float = 60.0) -> None:
        """Until the reports of ended queries are written; they arrive after the end of a query."""
        for q in queries:
            if not self._ending(str(q.runId)).wait(seconds):
                raise TimeoutError(f"no final report of query {q.name or q.id} within {seconds} s")

    def _ending(self, run_id: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run_id, threading.Event())

    def _write(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(self.path)


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch. A batch done again after a failure counts once, by its last report."""
    reports = spark.read.schema(REPORT).parquet(path)
    return reports.groupBy("query_id", "batch_id").agg(
        F.max_by(F.struct(*[n for n in reports.columns if n not in ("query_id", "batch_id")]), "reported_at").alias("r")
    ).select("query_id", "batch_id", "r.*")


def progress_totals(progress: DataFrame) -> DataFrame:
    """Batches, rows, late rows and mean rate per query over all its runs."""
    return progress.groupBy("query_id", "query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.try_divide(1000 * F.sum("input_rows"), F.sum("duration_ms")).alias("rows_per_second"))
