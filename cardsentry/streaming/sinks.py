"""Streaming sinks.

Every query gets its own checkpoint (offsets or processed files, plus
operator state); a restarted query resumes from it, so each input record is
reflected exactly once in the sink.  ``available_now=True`` processes what is
available and stops (scheduled jobs, tests); otherwise the query keeps
running on a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def _writer(df: DataFrame, checkpoint: str, output_mode: str, available_now: bool,
            processing_time: str | None, query_name: str | None):
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w


def stream_to_path(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                   output_mode: str = "append", available_now: bool = True,
                   processing_time: str | None = None, partition_by: list[str] | None = None,
                   query_name: str | None = None) -> StreamingQuery:
    """Append the stream to files at ``path`` (file sink with its own commit
    log, so readers only see completed micro-batches)."""
    w = _writer(df, checkpoint, output_mode, available_now, processing_time, query_name).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path)


def stream_to_table(df: DataFrame, table: str, checkpoint: str, fmt: str = "parquet",
                    path: str | None = None, output_mode: str = "append",
                    available_now: bool = True, processing_time: str | None = None,
                    partition_by: list[str] | None = None,
                    query_name: str | None = None) -> StreamingQuery:
    """Append the stream to a named table (created on first run)."""
    w = _writer(df, checkpoint, output_mode, available_now, processing_time, query_name).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    return w.toTable(table)


def stream_foreach_batch(df: DataFrame, fn, checkpoint: str, available_now: bool = True,
                         processing_time: str | None = None,
                         query_name: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to ``fn(batch_df, batch_id)``."""
    w = _writer(df, checkpoint, "append", available_now, processing_time, query_name)
    return w.foreachBatch(fn).start()


def drain(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append the stream to files until nothing is left to read, then stop.

    Unlike ``availableNow`` this takes as many bounded micro-batches as a source wants, and
    the closing batch without data that evicts state by the newest watermark."""
    query = df.writeStream.option("checkpointLocation", checkpoint).format(fmt).start(path)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def finish(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; re-raise its failure.

    A query that is still running after ``timeout_s`` is stopped and raises
    ``TimeoutError``: what it has written so far is not its whole result."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish within {timeout_s} s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query {query.name or query.id} failed: {exc}")
    return query
