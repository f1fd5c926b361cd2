"""Rows that a windowed count drops as late, kept in a side table.

The count itself only tells how many rows it dropped.  Its checkpoint holds what
is needed to find them: the offsets and the watermark of every micro-batch.  The
late branch reads the offset range of each finished batch again (batch reads of
the topic), keeps the rows whose window had ended by the watermark, and writes
them to a folder of the batch, so that rows counted or still waiting and rows set
aside add up to the rows read.  A batch is written once; a repeated run replaces
its own folders only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardsentry.operators.windows import EVENT_TIME
from cardsentry.sources.paths import list_names
from cardsentry.streaming.offsets import committed_batches


def late_rows(rows: DataFrame, late_before_ms: int, size: str, event_time: str = EVENT_TIME) -> DataFrame:
    """The rows whose window had ended by the watermark; rows without event time are in no window."""
    border: Column = F.timestamp_millis(F.lit(late_before_ms))
    return (rows.where(F.window(event_time, size)["end"] <= border) if late_before_ms else rows.limit(0)) \
        .withColumn("late_watermark", border)


def keep_late_rows(spark: SparkSession, checkpoint: str, read_range: Callable[[dict | None, dict], DataFrame],
                   path: str, size: str = "1 minute", event_time: str = EVENT_TIME) -> list[int]:
    """Set aside the late rows of the finished batches of a count; the batches worked on.

    ``read_range(start, end)`` gives the rows that reach the count from the offsets
    ``[start, end)`` (``start`` is None before the first batch).
    """
    kept = {int(n.removeprefix("batch_id=")) for n in list_names(spark, path) if n.startswith("batch_id=")}
    worked = []
    for batch in committed_batches(spark, checkpoint):
        if batch.batch_id in kept or not batch.late_before_ms or batch.start == batch.end:
            continue
        rows = late_rows(read_range(batch.start, batch.end), batch.late_before_ms, size, event_time)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch.batch_id}")
        worked.append(batch.batch_id)
    return worked
