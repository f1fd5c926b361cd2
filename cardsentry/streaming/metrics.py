"""What a streaming query reports about itself.

``recentProgress`` keeps the last reports only (100 by default).  ``ProgressLog``
is a listener that keeps every report of the queries of a session from its
registration on; the functions below read it where it is registered.  Reports
are small (one per micro-batch, a few numbers each); they are read on the driver
and turned into a DataFrame.
"""

from __future__ import annotations

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Every progress report, by run of a query.

    ``on_progress(query_name, report)`` is called for each (a long-running query
    records its metrics that way)."""

    _registered: dict = {}

    def __init__(self):
        self.reports: dict[str, list[dict]] = {}
        self.ended: set[str] = set()
        self.on_progress: dict[str, object] = {}
        self.lock = threading.Lock()

    @classmethod
    def of(cls, spark: SparkSession) -> ProgressLog:
        """The session's log, registered on first use (before its queries start)."""
        key = spark.sparkContext.applicationId
        if key not in cls._registered:
            cls._registered[key] = cls()
            spark.streams.addListener(cls._registered[key])
        return cls._registered[key]

    def onQueryStarted(self, event):
        with self.lock:
            self.reports.setdefault(str(event.runId), [])

    def onQueryProgress(self, event):
        report = json.loads(event.progress.json)
        with self.lock:
            self.reports.setdefault(report["runId"], []).append(report)
            call = self.on_progress.get(report.get("name"))
        if call is not None:
            call(report)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.lock:
            self.ended.add(str(event.runId))

    def of_query(self, query: StreamingQuery, wait_s: float = 30.0) -> list[dict] | None:
        """All reports of a run; waits for the last ones of a run that has ended.
        None when the run was started before the log was registered."""
        run = str(query.runId)
        until = time.time() + wait_s
        while not query.isActive and time.time() < until:
            with self.lock:
                if run in self.ended or run not in self.reports:
                    break
            time.sleep(0.05)
        with self.lock:
            if run not in self.reports:
                return None
            if not query.isActive and run not in self.ended:
                raise TimeoutError(f"the reports of query run {run} did not arrive")
            return list(self.reports[run])


PROGRESS_SCHEMA = ("batch_id long, input_rows long, rows_dropped_by_watermark long, "
                   "state_rows long, state_memory_bytes long")


def _progress(query: StreamingQuery) -> list[dict]:
    for log in ProgressLog._registered.values():
        found = log.of_query(query)
        if found is not None:
            return found
    out = []
    for p in query.recentProgress:
        out.append(p if isinstance(p, dict) else p.jsonValue if hasattr(p, "jsonValue") else dict(p))
    return out


def progress_rows(query: StreamingQuery) -> list[tuple]:
    rows = []
    for p in _progress(query):
        ops = p.get("stateOperators") or []
        rows.append((
            int(p.get("batchId", -1)),
            int(p.get("numInputRows", 0)),
            sum(int(o.get("numRowsDroppedByWatermark", 0)) for o in ops),
            sum(int(o.get("numRowsTotal", 0)) for o in ops),
            sum(int(o.get("memoryUsedBytes", 0)) for o in ops),
        ))
    return rows


def progress_frame(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    rows = [r for q in queries for r in progress_rows(q)]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


QUALITY_SCHEMA = ("dataset string, batch_id long, expectation string, action string, "
                  "passed_records long, failed_records long")


def quality_rows(query: StreamingQuery, name: str, dataset: str, expectations) -> list[tuple]:
    """Per micro-batch and expectation: passed and failed records, from the
    metrics observed under ``name``."""
    return [row for p in _progress(query) for row in report_rows(p, name, dataset, expectations)]


def report_rows(report: dict, name: str, dataset: str, expectations) -> list[tuple]:
    """The rows of one progress report."""
    metrics = (report.get("observedMetrics") or {}).get(name)
    if not metrics:
        return []
    if hasattr(metrics, "asDict"):
        metrics = metrics.asDict()
    total = int(metrics.get("input_records") or 0)
    return [(dataset, int(report.get("batchId", -1)), e.name, e.action, total - int(metrics.get(e.name) or 0),
             int(metrics.get(e.name) or 0)) for e in expectations]


def record_while_running(spark: SparkSession, query_name: str, name: str, dataset: str, expectations,
                         path: str) -> None:
    """Append the expectation metrics of a long-running query to the table at
    ``path`` as its micro-batches end (call before the query starts)."""
    def write(report: dict) -> None:
        rows = report_rows(report, name, dataset, expectations)
        if rows:
            _append_quality(spark, rows, path)

    ProgressLog.of(spark).on_progress[query_name] = write


def _append_quality(spark: SparkSession, rows: list[tuple], path: str) -> None:
    (spark.createDataFrame(rows, QUALITY_SCHEMA).coalesce(1).write.mode("append")
     .partitionBy("dataset").parquet(path))


def record_quality(spark: SparkSession, query: StreamingQuery, name: str, dataset: str,
                   expectations, path: str) -> None:
    """Append the query's expectation metrics to the table at ``path``
    (a few rows per micro-batch; partitioned by dataset)."""
    rows = quality_rows(query, name, dataset, expectations)
    if rows:
        _append_quality(spark, rows, path)


def observed(query: StreamingQuery, name: str) -> dict:
    """Sum of the observed metrics ``name`` over the query's micro-batches."""
    total: dict = {}
    for p in _progress(query):
        metrics = (p.get("observedMetrics") or {}).get(name)
        if not metrics:
            continue
        if hasattr(metrics, "asDict"):
            metrics = metrics.asDict()
        for k, v in metrics.items():
            total[k] = total.get(k, 0) + int(v or 0)
    return total
