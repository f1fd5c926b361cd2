"""JSON feeds whose schema grows: a versioned schema log and an evolving sink.

The first schema is inferred from the files present at the first run and
published as version 0.  A micro-batch that holds unknown fields is not written:
the fields are published with their inferred types as the next version, and the
batch fails with ``SchemaChanged``.  The restarted query reads the same batch
again, now with the new columns, and goes on.  Files written before stay as they
are; ``read_evolved`` reads all of them with the newest schema.  What does not
fit the schema (unreadable lines, a value of another type) goes to
``_rescued_data`` as before.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardsentry.functions.parsing import with_rescued
from cardsentry.sources.paths import list_names, publish, read_small
from cardsentry.streaming.sinks import finish, stream_foreach_batch

#: More new fields in one batch than this are a broken feed, not a new version of it.
MAX_NEW_FIELDS = 100


class SchemaChanged(RuntimeError):
    """A batch held fields that the schema did not know; they are known now."""


class SchemaLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in list_names(self.spark, self.path) if n.endswith(".json") and n[0].isdigit()]

    def schema(self, version: int | None = None) -> T.StructType | None:
        """A version's schema, the newest by default; None before the first."""
        versions = self.versions()
        if not versions:
            return None
        wanted = max(versions) if version is None else version
        return T.StructType.fromJson(json.loads(read_small(self.spark, f"{self.path}/{wanted:010d}.json")))

    def add(self, schema: T.StructType) -> int:
        version = len(self.versions())
        publish(self.spark, f"{self.path}/{version:010d}.json", schema.json())
        return version


def infer(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the JSON-lines files below ``path``; unreadable lines give no field, nor do folder names."""
    return (spark.read.option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").json(path).schema)


def unknown_fields(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """The lines that hold fields outside the schema, and the names of these fields."""
    keys = F.map_keys(F.from_json("value", T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"}))
    extra = F.array_except(keys, F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>"))
    found = lines.where(F.size(extra) > 0)
    names = [r[0] for r in found.select(F.explode(extra).alias("name")).distinct().limit(MAX_NEW_FIELDS + 1).collect()]
    if len(names) > MAX_NEW_FIELDS:
        raise ValueError(f"more than {MAX_NEW_FIELDS} unknown fields in one batch")
    return found, sorted(names)


class EvolvingSink:
    """``foreachBatch`` sink of JSON lines (``value``, ``source_file``) into ``out_path``."""

    def __init__(self, log: SchemaLog, out_path: str):
        self.log, self.out_path = log, out_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        schema = self.log.schema()
        batch = batch.persist()
        try:
            lines, names = unknown_fields(batch, schema)
            if names:
                # the lines with unknown fields alone, from files: what inference reads does not go through the driver
                sample = f"{self.log.path}/_samples/batch_{batch_id}_{len(self.log.versions())}"
                lines.select("value").write.mode("overwrite").text(sample)
                known = set(schema.fieldNames())
                new = [f for f in infer(batch.sparkSession, sample).fields if f.name not in known]
                version = self.log.add(T.StructType(schema.fields + new))
                raise SchemaChanged(f"new fields {', '.join(f.name for f in new)}: schema version {version}")
            rows = with_rescued(batch, "value", schema)
            rows = rows.select(*[F.col("data").getField(f.name).alias(f.name) for f in schema.fields],
                               "_rescued_data", "source_file")
            rows.write.mode("overwrite").parquet(f"{self.out_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()


def stream_evolving(spark: SparkSession, feed: str, schema_location: str, out_path: str, checkpoint: str,
                    available_now: bool = True, processing_time: str | None = None,
                    max_files_per_trigger: int | None = None):
    """Start the stream of a feed whose schema may grow; a run that meets new fields fails with ``SchemaChanged``."""
    log = SchemaLog(spark, schema_location)
    if log.schema() is None:
        log.add(infer(spark, feed))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(feed).select("value", F.col("_metadata.file_path").alias("source_file"))
    return stream_foreach_batch(lines, EvolvingSink(log, out_path), checkpoint, available_now, processing_time)


def run_evolving(spark: SparkSession, feed: str, schema_location: str, out_path: str, checkpoint: str,
                 max_changes: int = 10, **options) -> int:
    """Work a feed off, starting again after every change of its schema; the number of changes.

    A failure that is no change of the schema is raised.
    """
    log = SchemaLog(spark, schema_location)
    for changes in range(max_changes + 1):
        before = len(log.versions()) or 1
        query = stream_evolving(spark, feed, schema_location, out_path, checkpoint, **options)
        try:
            finish(query)
            return changes
        except Exception:  # noqa: BLE001 - raised unless the schema has grown meanwhile
            if len(log.versions()) <= before:
                raise
    raise RuntimeError(f"the schema of {feed} changed more than {max_changes} times")


def read_evolved(spark: SparkSession, schema_location: str, out_path: str) -> DataFrame:
    """Everything written so far with the newest schema; columns that came later are null in earlier rows."""
    schema = SchemaLog(spark, schema_location).schema()
    fields = schema.fields + [T.StructField("_rescued_data", T.StringType()), T.StructField("source_file", T.StringType())]
    return spark.read.schema(T.StructType(fields)).option("basePath", out_path).parquet(f"{out_path}/batch_id=*")
