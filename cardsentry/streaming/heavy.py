"""Heavy keys of a stream from a mergeable summary of fixed size.

Every micro-batch counts its keys (combined map-side) and merges them into the
summary of the batches before: counts are added, the ``capacity`` largest stay, and
the next largest count is taken off all of them.  So a summary has ``capacity`` rows
whatever the number of keys, and an estimate is below the true count by at most
``rows / (capacity + 1)``; a key above that share is never lost.  No history is read.

The summary of a batch lies in a folder of its own and is made from the newest one
before it, so a replayed batch gives the same summary again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardsentry.sources.paths import list_names, remove

SUMMARY = "key string, estimate long, missed long, rows long"


def merge(counts: DataFrame, capacity: int) -> DataFrame:
    """Summary of ``(key, estimate, missed, rows)`` rows: ``missed`` is what the estimates of this
    summary may lack, ``rows`` what it has seen (both the same in all rows)."""
    spark = counts.sparkSession
    added = counts.where(F.col("key").isNotNull()).groupBy("key").agg(F.sum("estimate").alias("estimate"))
    top = added.orderBy(F.col("estimate").desc(), "key").limit(capacity + 1).collect()      # capacity + 1 rows
    totals = counts.agg(F.sum("missed"), F.sum("rows")).first()
    off = top[capacity].estimate if len(top) > capacity else 0
    missed, rows = (totals[0] or 0) + off, totals[1] or 0
    kept = [(r.key, r.estimate - off, 0, 0) for r in top[:capacity] if r.estimate > off]
    return spark.createDataFrame([(None, 0, missed, rows)] + kept, SUMMARY)


class HeavyKeys:
    """``foreachBatch`` sink that keeps the summary of a key column below ``path``."""

    def __init__(self, path: str, key: str, capacity: int = 1000, keep: int = 4):
        self.path, self.key, self.capacity, self.keep = path, key, capacity, keep

    def _batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.removeprefix("batch_id=")) for n in list_names(spark, self.path) if n.startswith("batch_id="))

    def summary(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest summary (of a batch before ``before``)."""
        known = [b for b in self._batches(spark) if before is None or b < before]
        return spark.read.schema(SUMMARY).parquet(f"{self.path}/batch_id={known[-1]}") if known else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = (batch.groupBy(F.col(self.key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("estimate"))
                  .select("key", "estimate", F.lit(0).cast("long").alias("missed"), F.col("estimate").alias("rows")))
        old = self.summary(spark, batch_id)
        counts = (counts if old is None else counts.unionByName(old)).persist()
        try:
            merge(counts, self.capacity).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        finally:
            counts.unpersist()
        for b in self._batches(spark)[:-self.keep]:
            remove(spark, f"{self.path}/batch_id={b}")

    def candidates(self, spark: SparkSession, min_share: float) -> DataFrame:
        """``(key)``: every key that holds at least ``min_share`` of the rows seen, and maybe keys
        that are short of it by the summary's error; at most ``capacity``."""
        found = self.summary(spark)
        if found is None:
            return spark.createDataFrame([], f"{self.key} string")
        seen = found.where("key IS NULL").select(F.col("missed").alias("m"), F.col("rows").alias("r"))
        return (found.where("key IS NOT NULL").crossJoin(F.broadcast(seen))          # one row
                .where(F.col("estimate") + F.col("m") >= F.lit(min_share) * F.col("r")).select(F.col("key").alias(self.key)))
