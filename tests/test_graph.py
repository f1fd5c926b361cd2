"""The dataset graph as named tables, run to completion on sf0.001."""

import pytest

from cardsentry.plans import catalog as C
from cardsentry.plans.graph import Layout, run_graph
from cardsentry.plans.runs import DriverTables, Run
from cardsentry.sources import driver_tables as D
from cardsentry.sources.kafka import kafka_options, read_kafka
from conftest import SF_SMALL


def test_graph_with_bucketed_dimension(spark):
    run = Run(spark, "graph_test")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_test")
    run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.stream("customer"), src.table("nation")),
              C.watchlist_feed(run, src), dimension_buckets=4)
    direct_hv = C.q_high_value_alert(spark, SF_SMALL)
    assert spark.table(layout.table("high_value_transaction_alert")).count() == direct_hv.count()
    direct_fraud = C.q_fraud_card_alert(spark, SF_SMALL)
    fraud = spark.table(layout.table("fraud_card_alert"))
    assert fraud.count() == direct_fraud.count() > 0
    outbox = spark.read.parquet(layout.path("fraud_card_alert_outbox"))
    assert outbox.select("alert_id").distinct().count() == outbox.count() == fraud.count()
    desc = spark.sql(f"DESCRIBE TABLE EXTENDED {layout.table('customer_dimension')}").collect()
    assert any(r.col_name == "Bucket Columns" for r in desc)


def test_kafka_options_and_missing_connector(spark):
    opts = kafka_options("broker:9092", "transactions", api_key="k", api_secret="s")
    assert opts["kafka.security.protocol"] == "SASL_SSL" and "username=\"k\"" in opts["kafka.sasl.jaas.config"]
    assert "kafka.security.protocol" not in kafka_options("broker:9092", "t")
    with pytest.raises(Exception) as err:
        read_kafka(spark, opts)
    assert "kafka" in str(err.value).lower()


def test_graph_with_table_backed_watchlist_join(spark):
    run = Run(spark, "graph_tables")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_tables")
    run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.stream("customer"), src.table("nation")),
              C.watchlist_feed(run, src), watchlist_join="tables", card_buckets=8)
    direct = C.q_fraud_card_alert(spark, SF_SMALL)
    fraud = spark.table(layout.table("fraud_card_alert"))
    cols = [c for c in direct.columns]
    assert sorted(map(tuple, C.comparable(fraud).select(*cols).collect())) == sorted(map(tuple, direct.collect()))
    outbox = spark.read.parquet(layout.path("fraud_card_alert_outbox"))
    assert outbox.select("alert_id").distinct().count() == outbox.count() == direct.count()


def test_graph_records_quality_metrics(spark):
    run = Run(spark, "graph_dq")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_dq")
    run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.stream("customer"), src.table("nation")),
              C.watchlist_feed(run, src), notifications=False)
    dq = spark.read.parquet(layout.path("dq_metrics"))
    got = {(r.dataset, r.expectation): (r.passed_records, r.failed_records)
           for r in dq.groupBy("dataset", "expectation").sum("passed_records", "failed_records")
           .toDF("dataset", "expectation", "passed_records", "failed_records").collect()}
    events = src.table("events").count()
    silver = spark.table(layout.table("silver_transactions")).count()
    assert got[("silver_transactions", "valid_customer_id")][0] == silver
    assert sum(got[("silver_transactions", "valid_transaction_id")]) == events
    assert ("silver_watchlist", "no_rescued_data") in got and ("silver_customers", "valid_customer_id") in got


def test_dimension_layout_auto(spark, tmp_dir, monkeypatch):
    from cardsentry.plans import graph
    spark.range(1000).selectExpr("cast(id AS string) AS customer_id").write.parquet(f"{tmp_dir}/dim")
    spark.catalog.createTable("dim_layout_test", path=f"{tmp_dir}/dim", source="parquet")
    assert graph.dimension_layout(spark, "dim_layout_test", "auto") is None       # small: broadcast
    assert graph.dimension_layout(spark, "dim_layout_test", 16) == 16
    monkeypatch.setattr(graph, "BROADCAST_LIMIT_BYTES", 0)                        # as if too large
    assert graph.dimension_layout(spark, "dim_layout_test", "auto") == 8


def test_graph_with_hot_keys(spark):
    run = Run(spark, "graph_hot")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_hot")
    run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.stream("customer"), src.table("nation")),
              C.watchlist_feed(run, src), notifications=False, hot_share=0.05, watchlist_join="state")
    for hot in ("hot_cards", "hot_customers"):
        assert spark.read.parquet(layout.path(hot)).count() > 0      # sf0.001: 15 users, some hot
    direct_fraud = C.q_fraud_card_alert(spark, SF_SMALL)
    fraud = C.comparable(spark.table(layout.table("fraud_card_alert"))).select(*direct_fraud.columns)
    assert sorted(map(tuple, fraud.collect())) == sorted(map(tuple, direct_fraud.collect()))
    direct_hv = C.q_high_value_alert(spark, SF_SMALL)
    hv = C.comparable(spark.table(layout.table("high_value_transaction_alert"))).select(*direct_hv.columns)
    assert sorted(map(tuple, hv.collect())) == sorted(map(tuple, direct_hv.collect()))


def test_graph_with_customer_snapshot(spark):
    """Customers as a batch snapshot (as a JDBC read gives them)."""
    run = Run(spark, "graph_snapshot")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_snapshot")
    run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.table("customer"), src.table("nation")),
              C.watchlist_feed(run, src), notifications=False)
    assert spark.table(layout.table("high_value_transaction_alert")).count() == \
        C.q_high_value_alert(spark, SF_SMALL).count()


def test_graph_partitioned_by_date(spark):
    run = Run(spark, "graph_dates")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_dates", by_date=True)
    run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.stream("customer"), src.table("nation")),
              C.watchlist_feed(run, src))
    silver = spark.table(layout.table("silver_transactions"))
    day = silver.where("event_date = DATE'2024-01-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert day.count() == silver.where("to_date(transaction_timestamp) = DATE'2024-01-02'").count() > 0
    fraud = spark.table(layout.table("fraud_card_alert"))
    assert "event_date" in fraud.columns and fraud.count() == C.q_fraud_card_alert(spark, SF_SMALL).count()
    outbox = spark.read.parquet(layout.path("fraud_card_alert_outbox"))
    assert outbox.count() == fraud.count()


def test_graph_refreshing_dimension(spark):
    run = Run(spark, "graph_refresh")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_refresh")
    run_graph(spark, layout, C.kafka_stream(src), D.customer_records(src.stream("customer"), src.table("nation")),
              C.watchlist_feed(run, src), refresh_dimension=True)
    direct = C.q_high_value_alert(spark, SF_SMALL)
    hv = C.comparable(spark.table(layout.table("high_value_transaction_alert"))).select(*direct.columns)
    assert sorted(map(tuple, hv.collect())) == sorted(map(tuple, direct.collect()))
    outbox = spark.read.parquet(layout.path("high_value_transaction_alert_outbox"))
    assert outbox.count() == direct.count()


def test_graph_bounded_micro_batches(spark):
    """Backlog in bounded micro-batches: several batches per flow, same alerts."""
    run = Run(spark, "graph_bounded")
    src = DriverTables(spark, SF_SMALL)
    layout = Layout(run.root, prefix="graph_bounded", max_files_per_trigger=2)
    events = src.table("events")
    events.repartition(6).write.parquet(run.path("events"))
    kafka = D.kafka_records(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "2").parquet(run.path("events")),
                            src.table("nation"))
    queries = run_graph(spark, layout, kafka,
                        D.customer_records(src.stream("customer"), src.table("nation")),
                        C.watchlist_feed(run, src), notifications=False)
    assert len([p for p in queries["silver_transactions"].recentProgress if p["numInputRows"]]) > 1
    for key, table in (("high_value_alert", "high_value_transaction_alert"), ("fraud_card_alert", "fraud_card_alert")):
        direct = C.QUERIES[key](spark, SF_SMALL)
        got = C.comparable(spark.table(layout.table(table))).select(*direct.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, direct.collect()))
