"""Kafka transaction feed (batch and stream).

Connection details are passed in by the caller (read them from the secret
store of the platform); nothing is looked up here.  The Kafka connector is not
part of every Spark distribution, so the readers fail with a clear message
when it is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(bootstrap_servers: str, topic: str, api_key: str | None = None,
                  api_secret: str | None = None, starting_offsets: str = "earliest",
                  **extra: str) -> dict[str, str]:
    """Options for ``spark.read(Stream).format("kafka")`` with SASL_SSL/PLAIN
    authentication when a key is given.

    ``startingOffsets`` only matters on the first run of a stream; later runs
    resume from the offsets in the checkpoint.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if api_key is not None:
        jaas = ("org.apache.kafka.common.security.plain.PlainLoginModule required "
                f'username="{api_key}" password="{api_secret}";')
        opts.update({
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        })
    opts.update(extra)
    return opts


def _missing() -> RuntimeError:
    return RuntimeError(
        "the Kafka source is not on the classpath; start Spark with "
        "--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>")


def _connector_missing(err: Exception) -> bool:
    text = str(err).lower()
    return "kafka" in text and ("not_found" in text or "failed to find" in text)


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """All records currently in the topic (batch)."""
    opts = dict(options)
    opts.setdefault("endingOffsets", "latest")
    try:
        return spark.read.format("kafka").options(**opts).load()
    except Exception as err:  # noqa: BLE001 - surfaced with a hint
        if _connector_missing(err):
            raise _missing() from err
        raise


def read_kafka_stream(spark: SparkSession, options: dict[str, str],
                      max_offsets_per_trigger: int | None = None,
                      min_partitions: int | None = None) -> DataFrame:
    """The topic as an unbounded stream.

    By default one Spark task reads one topic partition, so a partition that
    carries a third of the traffic would be read by a single task;
    ``min_partitions`` (e.g. a few times the executor cores) makes Spark split
    the offset ranges of large partitions over several tasks.
    ``max_offsets_per_trigger`` bounds the size of a micro-batch (and so the
    memory a stateful micro-batch needs after a backlog).
    """
    opts = dict(options)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    try:
        return spark.readStream.format("kafka").options(**opts).load()
    except Exception as err:  # noqa: BLE001
        if _connector_missing(err):
            raise _missing() from err
        raise
