"""Stepwise stream tests: files dropped in order, ``availableNow`` after each."""

import datetime as dt

from pyspark.sql import functions as F

from cardsentry.operators.alerts import watchlist_matches
from cardsentry.operators.windows import tumbling_counts
from cardsentry.schemas import TRANSACTION_PAYLOAD
from cardsentry.streaming.metrics import progress_rows
from cardsentry.streaming.sinks import finish, stream_to_path

WL_SCHEMA = ("watchlist_id string, watch_type string, entity_id string, risk_level string, action string, "
             "reason_code string, reason_description string, status string, effective_from timestamp, "
             "reported_by string, reported_source string, country string, city string")


def t(h, m):
    return dt.datetime(2024, 3, 1, h, m)


def tx_row(tid, card, ts):
    row = {f.name: None for f in TRANSACTION_PAYLOAD.fields}
    row.update(transaction_id=tid, card_number=card, transaction_timestamp=ts, customer_id="c", amount=1.0)
    return tuple(row[f.name] for f in TRANSACTION_PAYLOAD.fields)


def wl_row(wid, card, eff):
    return (wid, "CARD", card, "HIGH", "BLOCK", None, None, "ACTIVE", eff, None, None, None, None)


# FIXTURES.md join_steps: four ordered drops of (transactions / watchlist).
STEPS = [
    ([("T1", "C1", t(10, 0)), ("T0", "C2", t(9, 55))], [("W1", "C1", t(9, 30))]),
    ([("T2", "C9", t(14, 0))], [("W2", "C8", t(14, 0))]),
    ([("T3", "C1", t(14, 5))], [("W3", "C2", t(9, 0))]),
    ([("T4", "C7", t(14, 6))], [("W4", "C2", t(14, 6))]),
]


def write_step(spark, root, i):
    txs, wls = STEPS[i]
    spark.createDataFrame([tx_row(*r) for r in txs], TRANSACTION_PAYLOAD) \
        .write.mode("append").parquet(f"{root}/tx/step={i}")
    spark.createDataFrame([wl_row(*r) for r in wls], WL_SCHEMA) \
        .write.mode("append").parquet(f"{root}/wl/step={i}")


def run_join_steps(spark, root, **options):
    """One running query; each drop is processed before the next arrives."""
    out, ckpt = f"{root}/out", f"{root}/ckpt"
    write_step(spark, root, 0)
    txs_s = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{root}/tx")
    wl_s = spark.readStream.schema(WL_SCHEMA).parquet(f"{root}/wl")
    m = watchlist_matches(txs_s, wl_s, **options).select("transaction_id", "watchlist_id")
    q = stream_to_path(m, out, ckpt, available_now=False, processing_time="100 milliseconds")
    try:
        q.processAllAvailable()
        for i in range(1, len(STEPS)):
            write_step(spark, root, i)
            q.processAllAvailable()
    finally:
        q.stop()
    dropped = sum(r[2] for r in progress_rows(q))
    pairs = sorted((r[0], r[1]) for r in spark.read.parquet(out).collect())
    return pairs, dropped


def test_unbounded_join_matches_any_distance(spark, tmp_dir):
    # Without a time bound nothing can leave the join state, and Spark 4.1
    # keeps input rows behind the watermark too: W3 (09:00, arriving when the
    # watermark is 13:50) still matches T0 -- a late watchlist entry is not
    # lost.  Matches happen at any time distance and in either arrival order.
    pairs, dropped = run_join_steps(spark, tmp_dir)
    assert pairs == [("T0", "W3"), ("T0", "W4"), ("T1", "W1"), ("T3", "W1")]
    assert dropped == 0


def test_bounded_join(spark, tmp_dir):
    # Only transactions from effective_from to one hour after it; the
    # watermarks then let both sides' state be evicted.
    pairs, dropped = run_join_steps(spark, tmp_dir, max_lag="1 hour")
    assert pairs == [("T1", "W1")]


def test_salted_join_same_pairs(spark, tmp_dir):
    pairs, _ = run_join_steps(spark, tmp_dir, salt_buckets=4)
    assert pairs == [("T0", "W3"), ("T0", "W4"), ("T1", "W1"), ("T3", "W1")]


def test_null_event_time(spark, tmp_dir):
    rows = [tx_row("a", "K", t(10, 0)), tx_row("n", "K", None), tx_row("z", "K", t(12, 0))]
    spark.createDataFrame(rows, TRANSACTION_PAYLOAD).write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/in")
    finish(stream_to_path(tumbling_counts(stream), f"{tmp_dir}/w", f"{tmp_dir}/ck"))
    got = [(r.window_start, r.transactions_count) for r in spark.read.parquet(f"{tmp_dir}/w").collect()]
    assert got == [(t(10, 0), 1)]             # 12:00 still open, NULL time lost by the window
    wl = spark.createDataFrame([wl_row("W", "K", t(9, 0))], WL_SCHEMA)
    wl.write.parquet(f"{tmp_dir}/wl")
    wl_s = spark.readStream.schema(WL_SCHEMA).parquet(f"{tmp_dir}/wl")
    stream = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/in")
    m = watchlist_matches(stream, wl_s).select("transaction_id")
    finish(stream_to_path(m, f"{tmp_dir}/j", f"{tmp_dir}/ck2"))
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_dir}/j").collect()) == ["a", "n", "z"]


def test_restart_reads_nothing_twice(spark, tmp_dir):
    rows = [tx_row(f"t{i}", "K", t(10, i)) for i in range(30)]
    spark.createDataFrame(rows, TRANSACTION_PAYLOAD).write.parquet(f"{tmp_dir}/in/drop=a")
    for _ in range(2):
        stream = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/in")
        finish(stream_to_path(stream.select("transaction_id"), f"{tmp_dir}/o", f"{tmp_dir}/ck"))
    assert spark.read.parquet(f"{tmp_dir}/o").count() == 30
    assert F is not None


def test_batch_stream_agreement_on_windows(spark, tmp_dir):
    rows = [tx_row(f"t{i}", "K", t(10, i % 20)) for i in range(60)]
    df = spark.createDataFrame(rows, TRANSACTION_PAYLOAD)
    batch = tumbling_counts(df)
    assert sum(r.transactions_count for r in batch.collect()) == 60
    from cardsentry.operators.windows import sliding_counts
    assert sum(r.transactions_count for r in sliding_counts(df).collect()) == 5 * 60
    df.write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/in")
    finish(stream_to_path(tumbling_counts(stream), f"{tmp_dir}/w", f"{tmp_dir}/ck"))
    closed = {(r.window_start, r.transactions_count) for r in spark.read.parquet(f"{tmp_dir}/w").collect()}
    watermark = t(10, 19) - dt.timedelta(minutes=10)
    expected = {(r.window_start, r.transactions_count) for r in batch.collect() if r.window_end <= watermark}
    assert closed == expected


def test_watchlist_filters_and_event_time(spark):
    """D4: entries can be restricted by type and status; D2: the watchlist
    side can be watermarked on its ingestion time instead."""
    txs = spark.createDataFrame([tx_row("T1", "C1", t(10, 0)), tx_row("T2", "C2", t(10, 0))],
                                TRANSACTION_PAYLOAD)
    rows = [("W1", "CARD", "C1", "HIGH", "BLOCK", None, None, "ACTIVE", t(9, 0), None, None, None, None),
            ("W2", "ACCOUNT", "C2", "HIGH", "BLOCK", None, None, "ACTIVE", t(9, 0), None, None, None, None),
            ("W3", "CARD", "C2", "HIGH", "BLOCK", None, None, "INACTIVE", t(9, 0), None, None, None, None)]
    wl = spark.createDataFrame(rows, WL_SCHEMA)
    pairs = lambda df: sorted((r.transaction_id, r.watchlist_id) for r in df.collect())
    assert pairs(watchlist_matches(txs, wl, watermark=None)) == [("T1", "W1"), ("T2", "W2"), ("T2", "W3")]
    assert pairs(watchlist_matches(txs, wl, watermark=None, watch_types=["CARD"], statuses=["ACTIVE"])) \
        == [("T1", "W1")]
    wl_ing = wl.withColumn("bronze_ingestion_timestamp", F.lit(t(15, 0)))
    got = watchlist_matches(txs, wl_ing, watermark=None, watchlist_event_time="bronze_ingestion_timestamp")
    assert pairs(got) == [("T1", "W1"), ("T2", "W2"), ("T2", "W3")]


def run_matcher_steps(spark, root, **options):
    from cardsentry.streaming.matcher import WatchlistMatcher
    write_step(spark, root, 0)
    txs_s = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{root}/tx")
    wl_s = spark.readStream.schema(WL_SCHEMA).parquet(f"{root}/wl")
    matcher = WatchlistMatcher(f"{root}/matcher", card_buckets=4, **options)
    finish(matcher.start(txs_s, wl_s, f"{root}/ck_m"))
    for i in range(1, len(STEPS)):
        write_step(spark, root, i)
        txs_s = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{root}/tx")
        wl_s = spark.readStream.schema(WL_SCHEMA).parquet(f"{root}/wl")
        finish(matcher.start(txs_s, wl_s, f"{root}/ck_m"))
    return sorted((r.transaction_id, r.watchlist_id) for r in matcher.matches(spark).collect())


def test_table_backed_matcher_equals_join(spark, tmp_dir):
    """Same pairs as the unbounded stream-stream join, with the history in
    tables (and restarts between the drops)."""
    assert run_matcher_steps(spark, tmp_dir) == [("T0", "W3"), ("T0", "W4"), ("T1", "W1"), ("T3", "W1")]


def test_table_backed_matcher_bounded(spark, tmp_dir):
    # T0 (09:55) is within an hour after W3 (09:00).  The stream-stream join
    # has evicted T0 by the time W3 arrives and misses the pair; the
    # table-backed matcher loses nothing to lateness.
    assert run_matcher_steps(spark, tmp_dir, max_lag="1 hour") == [("T0", "W3"), ("T1", "W1")]


def test_table_backed_matcher_replay(spark, tmp_dir):
    from cardsentry.streaming.matcher import WatchlistMatcher
    write_step(spark, tmp_dir, 0)
    write_step(spark, tmp_dir, 1)
    m = WatchlistMatcher(f"{tmp_dir}/m", card_buckets=4)
    txs = spark.read.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/tx")
    wls = spark.read.schema(WL_SCHEMA).parquet(f"{tmp_dir}/wl")
    batch = m.source(txs, wls)
    m(batch, 0)
    m(batch, 0)                                  # the same micro-batch again
    assert sorted((r.transaction_id, r.watchlist_id) for r in m.matches(spark).collect()) == [("T1", "W1")]
    assert spark.read.parquet(m.tx_path).count() == 3


def test_salted_join_hot_cards_only(spark, tmp_dir):
    hot = spark.createDataFrame([("C1",)], "card string")
    pairs, _ = run_join_steps(spark, tmp_dir, salt_buckets=4, hot_cards=hot)
    assert pairs == [("T0", "W3"), ("T0", "W4"), ("T1", "W1"), ("T3", "W1")]


def test_refreshing_join_sees_dimension_updates(spark, tmp_dir):
    """A dimension rewritten by another job while the stream runs: the
    refreshing writer uses the new limits from the next micro-batch on."""
    from cardsentry.operators.alerts import high_value_alerts
    from cardsentry.streaming.refresh import RefreshingJoinWriter
    from cardsentry.streaming.sinks import stream_foreach_batch
    dim_cols = "customer_id string, transaction_limit double, email string, first_name string, last_name string"
    spark.createDataFrame([("c", 100.0, "c@x", "A", "B")], dim_cols).write.parquet(f"{tmp_dir}/dim")
    spark.catalog.createTable("refresh_dim_test", path=f"{tmp_dir}/dim", source="parquet")

    def drop(i, amount):
        row = tx_row(f"T{i}", "K", t(10, i))
        row = tuple(amount if f.name == "amount" else v for f, v in zip(TRANSACTION_PAYLOAD.fields, row))
        spark.createDataFrame([row], TRANSACTION_PAYLOAD).write.mode("append").parquet(f"{tmp_dir}/in/d={i}")

    drop(0, 50.0)
    stream = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/in")
    sink = RefreshingJoinWriter("refresh_dim_test", lambda b, d: high_value_alerts(b, d), f"{tmp_dir}/out")
    q = stream_foreach_batch(stream, sink, f"{tmp_dir}/ck", available_now=False, processing_time="100 milliseconds")
    try:
        q.processAllAvailable()
        # another job lowers the limit
        spark.createDataFrame([("c", 10.0, "c@x", "A", "B")], dim_cols).write.mode("overwrite").parquet(f"{tmp_dir}/dim")
        drop(1, 50.0)
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.transaction_id, r.transaction_limit) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == [("T1", 10.0)]
