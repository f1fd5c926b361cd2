"""What a query's checkpoint says about its micro-batches: offsets and watermarks."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from cardsentry.sources.paths import list_names, read_small


@dataclass(frozen=True)
class PlannedBatch:
    batch_id: int
    start: dict | None          # offsets by source topic; None before the first batch
    end: dict
    watermark_ms: int           # the watermark that this batch evicts with
    late_before_ms: int         # rows whose window ended by then were dropped as late


def committed_batches(spark: SparkSession, checkpoint: str) -> list[PlannedBatch]:
    """Finished micro-batches of a query with one offset-addressed source, oldest first.

    A stateful operator drops rows by the watermark of the batch before, and evicts by
    its own.  Batches whose predecessor the checkpoint has cleaned up are left out.
    """
    planned = sorted(int(n) for n in list_names(spark, f"{checkpoint}/offsets") if n.isdigit())
    done = {int(n) for n in list_names(spark, f"{checkpoint}/commits") if n.isdigit()}
    found, before = [], None
    for n in planned:
        lines = read_small(spark, f"{checkpoint}/offsets/{n}").splitlines()
        watermark = int(json.loads(lines[1]).get("batchWatermarkMs", 0))
        end = json.loads(lines[2])
        if n in done and (n == 0 or (before is not None and before[0] == n - 1)):
            found.append(PlannedBatch(n, before[1] if before else None, end, watermark, before[2] if before else 0))
        before = (n, end, watermark)
    return found
