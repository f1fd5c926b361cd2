"""The replayed topic: offsets, restarts, bounded micro-batches."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cardsentry.sources.topic import Index, _last_offsets, read_topic, stream_topic, write_topic
from cardsentry.streaming.sinks import finish, stream_to_path

TOPIC = "transactions"


def records(spark, offsets, partitions=3):
    """Offset ``o`` of every partition, as the broker delivers it."""
    return (spark.createDataFrame([(o,) for o in offsets], "o long")
            .select("o", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("p"))
            .select(F.lit(None).cast("binary").alias("key"), F.concat_ws("-", "p", "o").cast("binary").alias("value"),
                    F.lit(TOPIC).alias("topic"), F.col("p").cast("int").alias("partition"), F.col("o").alias("offset"),
                    F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, o)").alias("timestamp"),
                    F.lit(0).alias("timestampType")))


def run(spark, path, out, checkpoint, limit=None, start="earliest"):
    stream = stream_topic(spark, path, TOPIC, start, max_offsets_per_trigger=limit, checkpoint=checkpoint, records_per_task=7)
    q = stream.writeStream.option("checkpointLocation", checkpoint).format("parquet").start(out)
    try:
        q.processAllAvailable()
        return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()


def found(spark, out):
    return sorted((r.partition, r.offset) for r in spark.read.parquet(out).collect())


def test_stop_restart_and_bounded_batches(spark, tmp_dir):
    path, out, ck = f"{tmp_dir}/topic", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write_topic(records(spark, range(0, 20)), path, segment_offsets=8)
    assert max(run(spark, path, out, ck, limit=15, start='{"transactions": {"0": 5, "1": -1}}')) <= 15
    first = [(0, o) for o in range(5, 20)] + [(2, o) for o in range(20)]
    assert found(spark, out) == first
    assert run(spark, path, out, ck, limit=15) == []                       # nothing new
    write_topic(records(spark, range(20, 50), 4), path, segment_offsets=8)     # more records and a new partition
    # startingOffsets is for the first run only: the checkpoint goes on where it stood
    batches = run(spark, path, out, ck, limit=15, start="latest")
    assert found(spark, out) == sorted(first + [(p, o) for p in range(4) for o in range(20, 50)])
    assert sum(batches) == 120 and max(batches) <= 15 and len(batches) >= 8
    assert run(spark, path, out, ck, start="latest") == []
    rows = spark.read.parquet(out).where("partition = 2 AND offset = 21").collect()
    assert [(bytes(r.value), r.timestamp, r.topic, r.timestampType) for r in rows] == \
        [(b"2-21", dt.datetime(2024, 1, 1, 0, 0, 21), TOPIC, 0)]


def test_available_now_and_offsets_of_the_checkpoint(spark, tmp_dir):
    path, ck = f"{tmp_dir}/topic", f"{tmp_dir}/ck"
    write_topic(records(spark, range(6)), path)
    for _ in range(2):
        finish(stream_to_path(stream_topic(spark, path, TOPIC), f"{tmp_dir}/out", ck))
    assert found(spark, f"{tmp_dir}/out") == [(p, o) for p in range(3) for o in range(6)]
    assert _last_offsets(ck, TOPIC) == {"0": 6, "1": 6, "2": 6} and _last_offsets(f"{tmp_dir}/none", TOPIC) is None


def test_unpublished_files_are_not_seen(spark, tmp_dir):
    path = f"{tmp_dir}/topic"
    assert Index(path).refresh().latest() == {}
    write_topic(records(spark, range(4)), path)
    spark.createDataFrame([(json.dumps({"partition": 0, "first": 4, "last": 9, "records": 6, "file": "gone"}),)], "v string") \
        .write.text(f"{path}/_index/write=open")
    import os
    os.remove(f"{path}/_index/write=open/_SUCCESS")                        # a write whose index was never committed
    assert Index(path).refresh().latest() == {"0": 4, "1": 4, "2": 4}


def test_batch_ranges_and_input_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/topic"
    write_topic(records(spark, range(0, 64, 2)), path, segment_offsets=16)     # a compacted topic has gaps
    got = read_topic(spark, path, TOPIC, '{"transactions": {"0": 10, "1": -2, "2": -1}}', '{"transactions": {"0": 21, "1": 3, "2": -1}}')
    assert sorted((r.partition, r.offset) for r in got.collect()) == [(0, o) for o in range(10, 21, 2)] + [(1, 0), (1, 2)]
    index = Index(path).refresh()
    whole = index.ranges(index.earliest(), index.latest(), 8)
    assert len(whole) >= 12 and len({f for r in whole for f in r.files}) == sum(len(r.files) for r in whole)
    assert read_topic(spark, path, TOPIC).count() == 96
    with pytest.raises(ValueError):
        stream_topic(spark, path, TOPIC, max_offsets_per_trigger=5)
