"""Late rows set aside, state read as a table, feeds whose schema grows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cardsentry.operators.windows import sliding_counts, tumbling_counts
from cardsentry.sources.schema_log import SchemaLog, read_evolved, run_evolving
from cardsentry.sources.topic import read_topic, stream_topic, write_topic
from cardsentry.streaming.late import keep_late_rows
from cardsentry.streaming.offsets import committed_batches
from cardsentry.streaming.sinks import drain
from cardsentry.streaming.state import state_rows

TOPIC = "transactions"


def events(spark, first, minutes):
    rows = [(first + i, 60 * m) for i, m in enumerate(minutes)]
    return spark.createDataFrame(rows, "offset long, sec int").select(
        F.lit(None).cast("binary").alias("key"), F.lit(b"x").alias("value"), F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"), "offset",
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, sec)").alias("timestamp"), F.lit(0).alias("timestampType"))


def test_rows_counted_waiting_and_set_aside_are_the_rows_read(spark, tmp_dir):
    rng, topic, ck, out = random.Random(3), f"{tmp_dir}/topic", f"{tmp_dir}/ck", f"{tmp_dir}/out"
    time, seen = lambda df: df.withColumnRenamed("timestamp", "transaction_timestamp"), 0
    for step in range(3):
        minutes = [30 * step + rng.randrange(-25 if step else 0, 30) for _ in range(60)]
        write_topic(events(spark, seen, minutes), topic)
        seen += len(minutes)
        drain(tumbling_counts(time(stream_topic(spark, topic, TOPIC))), out, ck)
    import json
    late_path = f"{tmp_dir}/late"
    read = lambda start, end: time(read_topic(spark, topic, TOPIC, json.dumps(start or {}), json.dumps(end)))
    assert keep_late_rows(spark, ck, read, late_path)
    assert keep_late_rows(spark, ck, read, late_path) == []            # every batch once
    counted = spark.read.parquet(out).agg(F.sum("transactions_count")).first()[0]
    waiting = sum(r.value[0] for r in state_rows(spark, ck).collect())
    late = spark.read.parquet(late_path)
    assert late.count() > 0 and counted + waiting + late.count() == seen
    assert late.where("transaction_timestamp >= late_watermark").count() == 0
    assert [b.batch_id for b in committed_batches(spark, ck)][0] == 0


def test_sliding_panes_equal_the_expanded_windows(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(rng.randrange(5000),) for _ in range(300)], "s int").select(
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, s)").alias("transaction_timestamp"))
    want = rows.groupBy(F.window("transaction_timestamp", "5 minutes", "1 minute").alias("w")).count() \
        .select("w.start", "w.end", "count").collect()
    for watermark in (None, "10 minutes"):
        got = sliding_counts(rows, watermark=watermark)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_schema_grows_twice_and_other_failures_are_raised(spark, tmp_dir):
    feed, schema, out, ck = (f"{tmp_dir}/{n}" for n in ("feed", "schema", "out", "ck"))
    write_lines(feed, "a", ['{"id": "1", "n": 4}', '{"id": "2", "n": "four"}', "{cut"])
    assert run_evolving(spark, feed, schema, out, ck) == 0
    write_lines(feed, "b", ['{"id": "3", "note": "new"}', '{"id": "4"}'])
    assert run_evolving(spark, feed, schema, out, ck) == 1
    write_lines(feed, "c", ['{"id": "5", "note": "x", "score": 1.5, "flag": true}', '{"id": "6", "score": 2}'])
    assert run_evolving(spark, feed, schema, out, ck) == 1
    assert run_evolving(spark, feed, schema, out, ck) == 0                # nothing new
    log = SchemaLog(spark, schema)
    assert len(log.versions()) == 3 and log.schema(0).fieldNames() == ["id", "n"]
    assert {f.name: f.dataType.simpleString() for f in log.schema().fields if f.name in ("score", "flag")} == {"score": "double", "flag": "boolean"}
    rows = {r.id: r for r in read_evolved(spark, schema, out).collect()}
    assert len(rows) == 7 and rows["3"].note == "new" and rows["5"].score == 1.5 and rows["6"].flag is None
    assert rows["1"].note is None and rows[None]._rescued_data == "{cut"       # written before, still readable
    write_lines(feed, "d", ['{"id": "7"}'])
    os.chmod(f"{feed}/d.json", 0o644)
    with pytest.raises(Exception, match="capped"):
        import cardsentry.sources.schema_log as S
        original = S.unknown_fields
        try:
            S.unknown_fields = lambda *a: (_ for _ in ()).throw(ValueError("capped"))
            run_evolving(spark, feed, schema, out, ck)
        finally:
            S.unknown_fields = original
