"""Incrementally arriving JSON files (the watchlist feed).

Files are read as text lines and parsed with a pinned schema, so that the
fields that do not fit end up in ``_rescued_data`` instead of being lost; the
file each record came from is kept in ``source_file``.  The file source
records every file it has processed in the checkpoint, so each file is read
exactly once across restarts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardsentry.functions.parsing import with_rescued
from cardsentry.sources.paths import path_exists


def _all_text(schema: T.StructType) -> bool:
    return all(isinstance(f.dataType, T.StringType) for f in schema.fields)


def _project(lines: DataFrame, schema: T.StructType, now=None) -> DataFrame:
    if _all_text(schema):
        # Every field is text: one parse into a map gives the fields (any JSON
        # value reads as its text, as it would into a string field) and the
        # unknown keys to rescue.
        raw = F.from_json(F.col("value"), T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"})
        parsed = lines.select(F.col("value"), raw.alias("m"),
                              F.col("_metadata.file_path").alias("source_file"))
        known = F.array(*[F.lit(f.name) for f in schema.fields])
        extra = F.map_filter(F.col("m"), lambda k, v: ~F.array_contains(known, k))
        rescued = (F.when(F.col("value").isNull(), F.lit(None).cast("string"))
                   .when(F.col("m").isNull(), F.col("value"))
                   .otherwise(F.nullif(F.to_json(extra), F.lit("{}"))))
        cols = [F.col("m").getItem(f.name).alias(f.name) for f in schema.fields]
        cols += [rescued.alias("_rescued_data"), F.col("source_file"),
                 (now if now is not None else F.current_timestamp()).alias("ingestion_timestamp")]
        return parsed.select(*cols)
    parsed = with_rescued(lines.select("value", F.col("_metadata.file_path").alias("source_file")), "value", schema)
    cols = [F.col(f"data.{f.name}").alias(f.name) for f in schema.fields]
    cols += [F.col("_rescued_data"), F.col("source_file"),
             (now if now is not None else F.current_timestamp()).alias("ingestion_timestamp")]
    return parsed.select(*cols)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType,
                      now=None, path_glob: str | None = None) -> DataFrame:
    """Batch read of JSON-lines files with rescued data and lineage."""
    reader = spark.read.format("text")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return _project(reader.load(path), schema, now)


def stream_json_records(spark: SparkSession, path: str, schema: T.StructType | None = None,
                        now=None, path_glob: str | None = None,
                        max_files_per_trigger: int | None = None,
                        schema_location: str | None = None) -> DataFrame:
    """Only files not seen before, each once; ``key=value`` sub-folders are
    included.  Without ``schema``, the schema inferred from the files present
    at the first run and kept at ``schema_location`` is used."""
    if schema is None:
        if schema_location is None:
            raise ValueError("give a schema or a schema_location")
        schema = stored_schema(spark, path, schema_location)
    reader = spark.readStream.format("text")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _project(reader.load(path), schema, now)


def stored_schema(spark: SparkSession, sample_path: str, schema_location: str) -> T.StructType:
    """Schema inferred once from the files at ``sample_path`` and kept at
    ``schema_location`` so that every later run (and the stream) uses the same
    one.  Fields that appear later go to ``_rescued_data``."""
    if path_exists(spark, schema_location):
        return T.StructType.fromJson(json.loads(spark.read.text(schema_location).first()[0]))
    # the lines alone decide: unreadable ones give no column, and neither do
    # the folders that the files lie in
    inferred = (spark.read.option("primitivesAsString", "false").option("mode", "DROPMALFORMED")
                .option("recursiveFileLookup", "true").json(sample_path).schema)
    spark.createDataFrame([(inferred.json(),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(schema_location)
    return inferred


def write_json_records(df: DataFrame, path: str, partition_by: list[str] | None = None,
                       mode: str = "append") -> None:
    """Write records as JSON lines (one object per line)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
