"""Segmented tables, the outbox id index and the matcher history over many micro-batches."""

import random

from pyspark.sql import functions as F

from cardsentry.operators.notify import render_fraud
from cardsentry.sources.paths import list_names
from cardsentry.streaming import outbox as O
from cardsentry.streaming.matcher import WatchlistMatcher
from cardsentry.streaming.outbox import OutboxWriter
from cardsentry.streaming.segments import SegmentTable
from test_notify import ALERT_COLUMNS, alert


def rows(spark, numbers):
    return spark.createDataFrame([(n, n % 2) for n in numbers], "n long, half int").coalesce(1)


def content(spark, table, before=None):
    found = table.read(spark, table.segments(spark, before))
    return sorted(r.n for r in found.collect()) if found is not None else []


def test_merging_keeps_rows_and_bounds_the_segments(spark, tmp_dir):
    table = SegmentTable(f"{tmp_dir}/t", ["half"], arrange=lambda df: df.hint("rebalance", "half"), fan_in=3, keep_versions=4)
    for k in range(20):
        table.compact(spark, before=k)
        table.append(rows(spark, [2 * k, 2 * k + 1] if k % 5 else []), k)
        live = table.segments(spark)
        assert len(live) <= 2 * 3 + 1                      # two of a tier, 3 ** 3 > 20, and the new one
    assert content(spark, table) == [n for k in range(20) if k % 5 for n in (2 * k, 2 * k + 1)]
    assert sum(s.files for s in table.segments(spark)) <= 2 * len(table.segments(spark))
    # what was replaced goes after some versions, old manifests too
    assert len(list_names(spark, f"{tmp_dir}/t/_manifest")) <= 5
    assert len([n for n in list_names(spark, f"{tmp_dir}/t") if n.startswith("segment=")]) <= len(live) + 3 * 4 + 8


def test_a_reader_keeps_its_version_and_a_replay_its_history(spark, tmp_dir):
    table = SegmentTable(f"{tmp_dir}/t", ["half"], fan_in=2)
    for k in range(3):
        table.append(rows(spark, [k]), k)
    old = table.read(spark, table.segments(spark))
    assert table.compact(spark, before=3) == 1 and len(table.segments(spark)) == 2
    assert sorted(r.n for r in old.collect()) == [0, 1, 2]              # read after the merge
    assert content(spark, table) == [0, 1, 2]
    table.append(rows(spark, [7, 8]), 3)
    table.append(rows(spark, [8]), 3)                                   # a replay replaces its own rows
    assert content(spark, table) == [0, 1, 2, 8] and content(spark, table, before=3) == [0, 1, 2]
    table.append(rows(spark, []), 3)
    assert content(spark, table) == [0, 1, 2]
    # a merge that was lost before its commit is not seen, and is removed by the next writer
    rows(spark, [99]).write.partitionBy("half").parquet(f"{tmp_dir}/t/segment=m000000000000-000000000001-lost")
    again = SegmentTable(f"{tmp_dir}/t", ["half"], fan_in=2)
    assert content(spark, again) == [0, 1, 2]
    again.append(rows(spark, [5]), 4)
    assert not [n for n in list_names(spark, f"{tmp_dir}/t") if n.endswith("-lost")]


def test_empty_table(spark, tmp_dir):
    table = SegmentTable(f"{tmp_dir}/t", ["half"])
    assert table.segments(spark) == [] and table.read(spark, []) is None and table.compact(spark, 5) == 0
    assert table.append(rows(spark, []), 0) is None and content(spark, table) == []


def test_filters_find_every_id_and_few_others(spark):
    ids = spark.range(6000).select(F.concat(F.lit("A"), "id").alias("alert_id"), (F.col("id") % 3).cast("int").alias("id_bucket"))
    filters = O.id_filters(ids, "s").cache()
    assert filters.count() == 3 * 2 and {len(r.bits) for r in filters.collect()} == {O.BLOCK_BITS // 64}
    asked = spark.range(60000).select(F.concat(F.lit("A"), "id").alias("alert_id"), (F.col("id") % 3).cast("int").alias("id_bucket"), "id")
    found = (asked.join(filters, "id_bucket").where(F.col("block") == O.id_block(F.col("alert_id"), F.col("blocks")))
             .withColumn("positions", O.id_positions(F.col("alert_id"))).where(O.may_hold()))
    hits = [r.id for r in found.select("id").collect()]
    assert set(range(6000)) <= set(hits) and len(hits) - 6000 < 20


def test_outbox_over_many_batches_is_one_row_per_alert(spark, tmp_dir):
    fan_in = 2
    rng, sink = random.Random(fan_in), OutboxWriter(f"{tmp_dir}/outbox", render_fraud, id_buckets=4, fan_in=fan_in)
    first_seen = {}
    for k in range(7):
        names = [f"A{rng.randrange(60)}" for _ in range(8)]
        sink(spark.createDataFrame([alert(n, "x@example.com") for n in names], ALERT_COLUMNS), k)
        for n in names:
            first_seen.setdefault(n, k)
    out = spark.read.parquet(f"{tmp_dir}/outbox").collect()
    assert sorted((r.alert_id, r.batch_id) for r in out) == sorted(first_seen.items())
    assert len(sink.index.segments(spark)) <= 4


def test_outbox_reads_only_folders_that_may_hold_an_id(spark, tmp_dir):
    sink = OutboxWriter(f"{tmp_dir}/outbox", render_fraud, id_buckets=4)
    for k in range(4):
        sink(spark.createDataFrame([alert(f"A{k}-{i}", "") for i in range(20)], ALERT_COLUMNS), k)
        assert sink.opened == []                            # nothing but new ids: no index folder is read
    sink(spark.createDataFrame([alert("A2-7", ""), alert("new", "")], ALERT_COLUMNS), 4)
    assert len(sink.opened) == 1 and "segment=b000000000002/" in sink.opened[0]
    assert spark.read.parquet(f"{tmp_dir}/outbox").where("alert_id = 'A2-7'").count() == 1
    sink(spark.createDataFrame([alert("new", "")], ALERT_COLUMNS), 4)          # the batch again
    assert spark.read.parquet(f"{tmp_dir}/outbox").where("alert_id = 'new'").count() == 1


def test_matcher_over_many_batches(spark, tmp_dir):
    """The pairs do not depend on the merges; folders and reads of entries stay bounded."""
    rng = random.Random(5)
    events = [("T", f"t{i}", f"c{rng.randrange(7)}") if rng.random() < .7 else ("W", f"w{i}", f"c{rng.randrange(7)}") for i in range(48)]
    m = WatchlistMatcher(f"{tmp_dir}/m", card_buckets=4, fan_in=3)
    bucket = F.pmod(F.xxhash64("card_key"), F.lit(4)).cast("int")
    for k in range(12):
        part = spark.createDataFrame(events[4 * k:4 * k + 4], "side string, id string, card_key string")
        tx, wl = F.col("side") == "T", F.col("side") == "W"
        m(part.select("side", "card_key", F.when(tx, F.struct(F.col("id").alias("transaction_id"))).alias("t"),
                      F.when(wl, F.struct(F.col("id").alias("watchlist_id"))).alias("w"), bucket.alias("card_bucket")), k)
    want = sorted((t, w) for s, t, c in events if s == "T" for s2, w, c2 in events if s2 == "W" and c == c2)
    assert sorted((r.transaction_id, r.watchlist_id) for r in m.matches(spark).collect()) == want
    assert len(m.tx.segments(spark)) <= 7 and len(m.wl.segments(spark)) <= 7


def test_new_entries_are_broadcast_to_the_history_whatever_the_batch_holds(spark, tmp_dir):
    """The size that decides is that of the entries, not of the micro-batch they came in."""
    pairs, bucket = [], F.pmod(F.xxhash64("card_key"), F.lit(4)).cast("int")
    m = WatchlistMatcher(f"{tmp_dir}/m", card_buckets=4, broadcast_limit_bytes=50_000, transform=lambda df: pairs.append(df) or df)
    tx, wl = F.col("side") == "T", F.col("side") == "W"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for k in range(2):
            events = [("W", f"w{k}", f"c{k}")] + [("T", f"t{k}-{i}-" + "x" * 100, f"c{i % 50}") for i in range(2000)]
            part = spark.createDataFrame(events, "side string, id string, card_key string")
            m(part.select("side", "card_key", F.when(tx, F.struct(F.col("id").alias("transaction_id"))).alias("t"),
                          F.when(wl, F.struct(F.col("id").alias("watchlist_id"))).alias("w"), bucket.alias("card_bucket")), k)
        plan = pairs[1]._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert m.matches(spark).groupBy("watchlist_id").count().orderBy("watchlist_id").collect() == [("w0", 80), ("w1", 80)]
