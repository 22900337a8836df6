"""Expectation counts of a stream as a table (P-02, X-02).

``clean_stream`` observes its expectations; the counts of every micro-batch
travel with the query's progress.  :class:`ExpectationLog` listens for them and
writes one small file per (query, batch id): a batch that runs again after a
failure replaces its own counts, so nothing counts twice.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "expectation string, total_rows long, failed_rows long, query_id string, batch_id long"


class ExpectationLog(StreamingQueryListener):
    """Appends the observed counts named ``name`` of all queries to ``path``.

    Use it around runs: ``with ExpectationLog(spark, path) as log: q = …;
    log.wait(q)``.  Progress arrives on a thread of its own; ``wait`` returns
    when the query's last progress has been written, and raises what writing
    it raised."""

    def __init__(self, spark: SparkSession, path: str, name: str = "sensor_expectations"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self._error: Exception | None = None

    def __enter__(self) -> "ExpectationLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def _event(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def wait(self, query, timeout: float = 300) -> None:
        if not self._event(query.runId).wait(timeout):
            raise TimeoutError(f"no end of {query.runId} seen")
        if self._error is not None:
            raise self._error

    def onQueryStarted(self, event) -> None:
        self._event(event.runId)

    def onQueryProgress(self, event) -> None:
        try:
            counts = event.progress.observedMetrics.get(self.name)
            if counts is None:
                return
            counts = counts.asDict()
            total = int(counts.pop("rows") or 0)
            rows = [(e, total, int(n or 0)) for e, n in counts.items()]
            (self.spark.createDataFrame(rows, "expectation string, total_rows long, failed_rows long").coalesce(1)
             .write.mode("overwrite")
             .parquet(f"{self.path}/query_id={event.progress.id}/batch_id={event.progress.batchId}"))
        except Exception as e:  # noqa: BLE001 - told to the waiting thread
            self._error = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Every batch's counts: expectation, total_rows, failed_rows, query_id, batch_id."""
    return spark.read.schema(SCHEMA).parquet(path)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The same table as ``expectation_report``, over all batches."""
    return counts(spark, path).groupBy("expectation").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("failed_rows").alias("failed_rows"))
