"""Answers that must not depend on sizes, restarts, micro-batches or row order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardsentry.functions import rescued_data
from cardsentry.operators.alerts import watchlist_matches
from cardsentry.operators.joins import dimension_join
from cardsentry.operators.layers import latest_customers
from cardsentry.operators.resume import unpublished
from cardsentry.plans import catalog as C
from cardsentry.plans.graph import Layout, fixed_setting, run_graph
from cardsentry.plans.runs import DriverTables, Run
from cardsentry.schemas import TRANSACTION_PAYLOAD
from cardsentry.sources import driver_tables as D
from cardsentry.sources.files import stored_schema
from cardsentry.streaming.metrics import ProgressLog, progress_rows
from cardsentry.streaming.outbox import OutboxWriter
from cardsentry.streaming.sinks import finish, stream_to_path
from cardsentry.operators.notify import render_fraud
from conftest import SF_SMALL
from test_notify import ALERT_COLUMNS, alert
from test_sources import records
from test_streams import WL_SCHEMA, t, tx_row, wl_row
from test_functions import SMALL


def test_reports_of_all_micro_batches(spark):
    C_KEPT = "spark.sql.streaming.numRecentProgressUpdates"
    with C.session_conf(spark, {C_KEPT: "3"}):
        got = {r.expectation: (r.passed_records, r.failed_records) for r in C.q_dq_report_many_batches(spark, SF_SMALL).collect()}
    one = {r.expectation: (r.passed_records, r.failed_records) for r in C.q_dq_report(spark, SF_SMALL).collect()}
    assert got == one
    assert len(Run.recent[-2].queries[-1].recentProgress) <= 3 < C.MANY_FILES <= len(progress_rows(Run.recent[-2].queries[-1]))


def test_unfinished_query_raises(spark, tmp_dir):
    spark.createDataFrame([("a",)], "v string").write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema("v string").parquet(f"{tmp_dir}/in")
    q = stream_to_path(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=False, processing_time="1 hour")
    with pytest.raises(TimeoutError):
        finish(q, timeout_s=1)
    assert not q.isActive


def test_hot_set_may_change_between_runs(spark, tmp_dir):
    """Watchlist entries stored before a card became hot still meet its transactions."""
    def step(i, txs, wls):
        spark.createDataFrame([tx_row(*r) for r in txs], TRANSACTION_PAYLOAD).write.parquet(f"{tmp_dir}/tx/step={i}")
        spark.createDataFrame([wl_row(*r) for r in wls], WL_SCHEMA).write.parquet(f"{tmp_dir}/wl/step={i}")

    def run(hot):
        m = watchlist_matches(spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/tx"),
                              spark.readStream.schema(WL_SCHEMA).parquet(f"{tmp_dir}/wl"), salt_buckets=8,
                              hot_cards=spark.createDataFrame(hot, "card string"))
        finish(stream_to_path(m.select("transaction_id", "watchlist_id"), f"{tmp_dir}/out", f"{tmp_dir}/ck"))

    step(0, [("T0", "C9", t(9, 0))], [("W1", "C1", t(9, 0))])
    run([("C9",)])
    step(1, [(f"T{i}", "C1", t(10, i)) for i in range(1, 17)], [("W2", "C9", t(9, 0))])
    run([("C1",)])
    got = {(r[0], r[1]) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {(f"T{i}", "W1") for i in range(1, 17)} | {("T0", "W2")}


def test_settings_of_a_checkpoint_are_refused_when_changed(spark, tmp_dir):
    layout = Layout(tmp_dir)
    fixed_setting(spark, layout, "salt_buckets", 8)
    fixed_setting(spark, layout, "salt_buckets", 8)
    with pytest.raises(ValueError, match="salt_buckets was 8"):
        fixed_setting(spark, layout, "salt_buckets", 4)


def graph(spark, label, feed_rows=True, **options):
    run = Run(spark, label)
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix=label, by_date=options.pop("by_date", False))
    feed = run.path("watchlist_feed")
    lines = D.watchlist_lines(src.table("customer"), src.table("nation"))
    if feed_rows:
        D.write_feed(lines, feed)
    else:
        lines.limit(0).select("value").write.text(feed)
    queries = run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.stream("customer"), src.table("nation")),
                        feed, **options)
    return layout, queries


ALERTS = ("high_value_transaction_alert", "fraud_card_alert")


@pytest.mark.parametrize("by_date", [False, True])
def test_continuous_graph_equals_a_run_to_completion(spark, by_date):
    layout, queries = graph(spark, f"graph_cont_{by_date}".lower(), available_now=False, processing_time="200 milliseconds",
                            by_date=by_date)
    try:
        for _ in range(2):
            for q in queries.values():
                q.processAllAvailable()
        for name, key in zip(ALERTS, ("high_value_alert", "fraud_card_alert")):
            want = C.QUERIES[key](spark, SF_SMALL)
            got = C.comparable(spark.table(layout.table(name))).select(*want.columns)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
            assert ("event_date" in spark.table(layout.table(name)).columns) == by_date
            assert spark.read.parquet(layout.path(f"{name}_outbox")).count() == want.count()
        dq = spark.read.parquet(layout.path("dq_metrics")).where("dataset = 'silver_transactions'")
        events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
        assert dq.where("expectation = 'valid_transaction_id'").agg(F.sum(F.expr("passed_records + failed_records"))).first()[0] == events
    finally:
        for q in queries.values():
            q.stop()


def test_empty_watchlist_gives_an_empty_alert_table(spark):
    layout, _ = graph(spark, "graph_no_watchlist", feed_rows=False)
    assert spark.table(layout.table("fraud_card_alert")).count() == 0
    assert spark.table(layout.table("high_value_transaction_alert")).count() > 0


def test_match_options_are_honoured_or_refused(spark):
    layout, _ = graph(spark, "graph_status", fraud_options={"statuses": ["NO_SUCH_STATUS"]}, notifications=False)
    assert spark.table(layout.table("fraud_card_alert")).count() == 0
    with pytest.raises(ValueError, match="salt_buckets"):
        graph(spark, "graph_refused", fraud_options={"salt_buckets": 4}, notifications=False)


def test_customer_rows_do_not_depend_on_a_size(spark, monkeypatch):
    from cardsentry.operators import joins
    from cardsentry.plans import graph as G

    counts = []
    for limit in (1 << 30, 0):
        monkeypatch.setattr(G, "BROADCAST_LIMIT_BYTES", limit)
        monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", limit)
        run = Run(spark, f"graph_size_{limit}")
        src = DriverTables(spark, SF_SMALL)
        layout = Layout(run.root, prefix=f"graph_size_{limit}")
        twice = D.customer_records(src.table("customer"), src.table("nation"))
        run_graph(spark, layout, C.kafka_stream(src), twice.unionAll(twice), C.watchlist_feed(run, src), notifications=False)
        counts.append([spark.table(layout.table(n)).count() for n in ALERTS])
    once = [C.QUERIES[k](spark, SF_SMALL).count() for k in ("high_value_alert", "fraud_card_alert")]
    assert counts[0] == counts[1] and counts[0][0] == 2 * once[0]
    run = Run(spark, "graph_latest")
    layout = Layout(run.root, prefix="graph_latest")
    run_graph(spark, layout, C.kafka_stream(src), twice.unionAll(twice), C.watchlist_feed(run, src), notifications=False,
              latest_customers_only=True)
    assert [spark.table(layout.table(n)).count() for n in ALERTS] == once


def test_latest_customer_does_not_depend_on_row_order(spark):
    rows = [("c", float(x), dt.datetime(2024, 1, 1)) for x in (100, 10, 55)]
    schema = "customer_id string, transaction_limit double, silver_ingestion_timestamp timestamp"
    got = {tuple(latest_customers(spark.createDataFrame(r, schema)).first()) for r in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert got == {("c", 100.0, dt.datetime(2024, 1, 1))}


def test_spread_dimension_join_is_the_plain_join(spark):
    fact = spark.range(300).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                   .otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4)], "k string, v int")
    hot = spark.createDataFrame([("hot",), ("hot",)], "k string")
    plain = dimension_join(fact, dim, "k", broadcast_limit_bytes=0)
    spread = dimension_join(fact, dim, "k", broadcast_limit_bytes=0, hot_keys=hot)
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
    assert "Union" not in spread._jdf.queryExecution().optimizedPlan().toString()


def test_outbox_knows_an_alert_of_another_day(spark, tmp_dir):
    sink = OutboxWriter(f"{tmp_dir}/outbox", render_fraud, id_buckets=4)
    first, later = list(alert("A1", "x@example.com")), list(alert("A1", "x@example.com"))
    later[18] = later[18] + dt.timedelta(days=3)
    both = [tuple(first), tuple(later)]
    sink(spark.createDataFrame(both, ALERT_COLUMNS), 0)
    sink(spark.createDataFrame(both[::-1], ALERT_COLUMNS), 0)      # a replay in another row order
    sink(spark.createDataFrame([tuple(later), alert("A2", "")], ALERT_COLUMNS), 1)
    out = spark.read.parquet(f"{tmp_dir}/outbox")
    assert sorted((r.alert_id, r.batch_id) for r in out.collect()) == [("A1", 0), ("A2", 1)]


def test_nothing_published_publishes_all(spark):
    source = records(spark, ["WL000000", "unreadable", None, "WL000007"])
    assert unpublished(source, records(spark, [])).count() == 4
    assert [r[0] for r in unpublished(source, records(spark, ["odd"])).collect()] == ["WL000007"]


def test_inferred_schema_holds_payload_fields_only(spark, tmp_dir):
    lines = ['{"a":1,"b":"x"}', '{"a":2,"b":', "[1]"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/in/drop=1")
    schema = stored_schema(spark, f"{tmp_dir}/in", f"{tmp_dir}/schema")
    assert schema.simpleString() == "struct<a:bigint,b:string>"


def test_rescue_parses_twice(spark):
    df = spark.createDataFrame([('{"id":"w","n":"abc"}',)], "value string").select(rescued_data("value", SMALL))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField") == plan.count("from_json(MapType") == 1
    assert df.first()[0] == '{"n":"abc"}'


def test_no_shuffle_spreads_the_records(spark):
    run = Run(spark, "no_round_robin")
    src = DriverTables(spark, SF_SMALL)
    run.materialize(C.silver_tx_stream(src))
    plan = run.queries[-1]._jsq.streamingQuery().lastExecution().executedPlan().toString() \
        if hasattr(run.queries[-1]._jsq, "streamingQuery") else run.queries[-1]._jsq.explainInternal(False)
    assert "RoundRobin" not in plan
    assert ProgressLog.of(spark).of_query(run.queries[-1])
