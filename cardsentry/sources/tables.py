"""Named tables and path tables, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, table: str) -> DataFrame:
    """Static scan of a named table (``SELECT * FROM table``)."""
    return spark.sql(f"SELECT * FROM {table}")


def stream_scan(spark: SparkSession, table: str) -> DataFrame:
    """Rows appended to a named table since the last run of the reading query."""
    return spark.readStream.table(table)


def stream_path(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                path_glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files appearing under ``path`` as a stream (schema taken from the data
    when not given)."""
    if schema is None:
        reader = spark.read.format(fmt)
        if path_glob:
            reader = reader.option("pathGlobFilter", path_glob)
        schema = reader.load(path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def overwrite_table(df: DataFrame, table: str, path: str | None = None,
                    fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the content of a named table (created on first write)."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def comment_on(spark: SparkSession, table: str, comment: str) -> None:
    escaped = comment.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('comment' = '{escaped}')")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
                   fmt: str = "parquet") -> None:
    """Replace a named table with ``df`` hash-bucketed and sorted by ``key``.

    A later join on ``key`` reads each bucket as one partition and shuffles
    only the other side (no exchange of this table), which is what a
    dimension joined by every micro-batch needs.  Rows are brought to their
    bucket first so that each bucket is one file per table, not one per task.
    """
    writer = (df.repartition(buckets, key).write.mode("overwrite").format(fmt)
              .bucketBy(buckets, key).sortBy(key))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
