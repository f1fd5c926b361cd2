"""Stream-static joins that see dimension updates.

A stream-static join plans its static side once; files that another job
writes into the dimension table later are not seen by a long-running query.
``RefreshingJoinWriter`` runs the join per micro-batch in ``foreachBatch``
after refreshing the dimension table, and writes the batch's rows to its own
partition (``batch_id``, dynamic overwrite) so a replayed batch rewrites the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class RefreshingJoinWriter:
    def __init__(self, dim_table: str, build, out_path: str, partition_by: list[str] | None = None, written=None):
        """``build(batch, dimension) -> DataFrame``: the rows to write.  Folders
        are ``batch_id`` first, then ``partition_by``; ``written(batch_id)`` is
        called after a batch is written."""
        self.dim_table = dim_table
        self.build = build
        self.out_path = out_path
        self.partition_by = ["batch_id"] + list(partition_by or [])
        self.written = written

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.catalog.refreshTable(self.dim_table)
        out = self.build(batch, spark.read.table(self.dim_table))
        (out.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition_by).parquet(self.out_path))
        if self.written is not None:
            self.written(batch_id)
