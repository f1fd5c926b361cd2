"""Transaction counts per event-time window.

On a stream, ``withWatermark`` bounds the state: a window is emitted once,
when the watermark (largest event time seen minus the delay) passes its end,
and rows older than the watermark are dropped.  On a batch the watermark is
ignored and every window is returned.  The count is combined map-side before
the shuffle by window, so a busy minute costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

EVENT_TIME = "transaction_timestamp"
WATERMARK_DELAY = "10 minutes"


def window_counts(df: DataFrame, size: str, slide: str | None = None,
                  event_time: str = EVENT_TIME, watermark: str | None = WATERMARK_DELAY,
                  count_name: str = "transactions_count") -> DataFrame:
    src = df.select(event_time)
    if watermark:
        src = src.withWatermark(event_time, watermark)
    win = F.window(event_time, size, slide) if slide else F.window(event_time, size)
    return (src.groupBy(win.alias("window"))
            .agg(F.count(F.lit(1)).alias(count_name))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    F.col(count_name)))


def tumbling_counts(df: DataFrame, size: str = "1 minute", **kw) -> DataFrame:
    """Non-overlapping windows (10:00-10:01, 10:01-10:02, ...)."""
    return window_counts(df, size, None, **kw)


def sliding_counts(df: DataFrame, size: str = "5 minutes", slide: str = "1 minute", event_time: str = EVENT_TIME,
                   watermark: str | None = WATERMARK_DELAY, count_name: str = "transactions_count") -> DataFrame:
    """Overlapping windows: every row counts in size/slide windows.

    Rows are counted once, in panes of one slide; windows then add up panes, so it is the
    panes that are multiplied by size/slide and shuffled, never the rows.  ``size`` must be a
    multiple of ``slide``.
    """
    panes = window_counts(df, slide, None, event_time, watermark, "pane_count") if watermark is None else _panes(
        df, slide, event_time, watermark)
    time = F.col("window_start") if watermark is None else F.window_time("window")
    return (panes.groupBy(F.window(time, size, slide).alias("window"))
            .agg(F.sum("pane_count").alias(count_name))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    F.col(count_name)))


def _panes(df: DataFrame, slide: str, event_time: str, watermark: str) -> DataFrame:
    """Counts of one-slide windows; the window column carries the event time on to the next aggregation."""
    return (df.select(event_time).withWatermark(event_time, watermark)
            .groupBy(F.window(event_time, slide).alias("window")).agg(F.count(F.lit(1)).alias("pane_count")))
