"""The state of a streaming query as a table (Spark's state-store source)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def state_rows(spark: SparkSession, checkpoint: str, operator_id: int = 0, join_side: str | None = None,
               batch_id: int | None = None) -> DataFrame:
    """``(partition_id, key, value)`` of an operator's state after a batch (default: the newest).

    ``join_side`` (``left`` or ``right``) reads one side of a stream-stream join.
    """
    reader = spark.read.format("statestore").option("operatorId", str(operator_id))
    if join_side:
        reader = reader.option("joinSide", join_side)
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    return reader.load(checkpoint).select("partition_id", "key", "value")


def join_state(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """``(side, partition_id, join_key, rows)``: what a stream-stream join on one key remembers."""
    out = None
    for side in ("left", "right"):
        rows = state_rows(spark, checkpoint, operator_id, side)
        first = rows.schema["key"].dataType.fieldNames()[0]
        one = (rows.groupBy("partition_id", F.col("key").getField(first).cast("string").alias("join_key"))
               .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(side).alias("side"), "partition_id", "join_key", "rows"))
        out = one if out is None else out.unionByName(one)
    return out


def skewed_partitions(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """``(side, partition_id, rows, keys)`` of a stream-stream join's state, the fullest first."""
    return (join_state(spark, checkpoint, operator_id).groupBy("side", "partition_id")
            .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("keys")).orderBy(F.col("rows").desc(), "side", "partition_id"))
