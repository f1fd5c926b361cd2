"""The dataset graph as named tables, one streaming query per table.

    kafka -> bronze_transactions -> silver_transactions -> {high_value_transaction_alert,
        fraud_card_alert, transactions_count_by_min, transactions_count_by_min_sliding_window}
    json files -> bronze_watchlist -> silver_watchlist -> fraud_card_alert
    customers -> silver_customers -> {high_value_transaction_alert, fraud_card_alert}
    alert tables -> notification outboxes

Each table is written by its own query with its own checkpoint and read by the
next ones with ``readStream.table``.  With ``available_now=True`` the queries
are run one after the other in graph order (a scheduled job); otherwise they
are started together and keep running.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cardsentry.operators.alerts import enrich_matches, fraud_card_alerts, high_value_alerts, watchlist_matches
from cardsentry.operators.joins import BROADCAST_LIMIT_BYTES, estimated_bytes, heavy_hitters
from cardsentry.operators.layers import (CUSTOMER_EXPECTATIONS, CUSTOMER_OBSERVATION,
                                         TRANSACTION_EXPECTATIONS, TRANSACTION_OBSERVATION,
                                         WATCHLIST_EXPECTATIONS, WATCHLIST_OBSERVATION,
                                         bronze_transactions, latest_customers, silver_customers,
                                         silver_transactions, silver_watchlist)
from cardsentry.operators.notify import render_fraud, render_high_value
from cardsentry.operators.windows import sliding_counts, tumbling_counts
from cardsentry.schemas import WATCHLIST_RECORD
from cardsentry.sources.files import stream_json_records
from cardsentry.sources.paths import make_folder, partition_specs, write_once
from cardsentry.sources.tables import comment_on, overwrite_table, write_bucketed
from cardsentry.streaming.matcher import WatchlistMatcher
from cardsentry.streaming.metrics import ProgressLog, record_quality, record_while_running
from cardsentry.streaming.refresh import RefreshingJoinWriter
from cardsentry.streaming.outbox import OutboxWriter
from cardsentry.streaming.sinks import finish, stream_foreach_batch, stream_to_table

TABLE_COMMENTS = {
    "bronze_transactions": "Raw Kafka records of card transactions",
    "silver_transactions": "Parsed and checked card transactions",
    "silver_customers": "Customer dimension with contact data and limits",
    "bronze_watchlist": "Raw fraud watchlist records from JSON files",
    "silver_watchlist": "Cleaned fraud watchlist entries",
    "high_value_transaction_alert": "Transactions above the customer's limit",
    "fraud_card_alert": "Transactions on cards of the fraud watchlist",
    "transactions_count_by_min": "Transactions per minute (tumbling window)",
    "transactions_count_by_min_sliding_window": "Transactions per 5 minutes, every minute",
    "customer_dimension": "Latest row per customer, bucketed by customer_id",
}

# Expectations of the silver flows: observation name and rules.
QUALITY = {
    "silver_transactions": (TRANSACTION_OBSERVATION, TRANSACTION_EXPECTATIONS),
    "silver_customers": (CUSTOMER_OBSERVATION, CUSTOMER_EXPECTATIONS),
    "silver_watchlist": (WATCHLIST_OBSERVATION, WATCHLIST_EXPECTATIONS),
}


# Event time of the tables that can be partitioned by day (``Layout.by_date``).
EVENT_TIME = {
    "bronze_transactions": "timestamp",
    "silver_transactions": "transaction_timestamp",
    "high_value_transaction_alert": "transaction_timestamp",
    "fraud_card_alert": "transaction_timestamp",
    "transactions_count_by_min": "window_start",
    "transactions_count_by_min_sliding_window": "window_start",
}


@dataclass
class Layout:
    root: str
    prefix: str = "fraud"
    fmt: str = "parquet"
    comments: dict = field(default_factory=lambda: dict(TABLE_COMMENTS))
    # Add ``event_date`` to the tables of EVENT_TIME and partition them by it,
    # so that reads filtered by day only list and read those days.
    by_date: bool = False
    # Upper bound of new files per micro-batch for every flow that reads a
    # table or the watchlist folder: a backlog (say, after an outage) is then
    # worked off in bounded micro-batches instead of one huge one.
    max_files_per_trigger: int | None = None

    def table(self, name: str) -> str:
        return f"{self.prefix}_{name}"

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def read_stream(self, spark: SparkSession, name: str) -> DataFrame:
        reader = spark.readStream
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(self.max_files_per_trigger))
        return reader.table(self.table(name))


def publish_customer_dimension(spark: SparkSession, layout: Layout, buckets: int | None,
                               latest: bool = False) -> DataFrame:
    """Batch step: ``silver_customers`` (``latest``: one row per customer) as the
    table ``customer_dimension``, bucketed by ``customer_id`` when ``buckets`` is
    given (joined by every micro-batch without being shuffled).  Re-run it to
    refresh the dimension."""
    name = layout.table("customer_dimension")
    rows = spark.read.table(layout.table("silver_customers"))
    rows = latest_customers(rows) if latest else rows
    if buckets:
        write_bucketed(rows, name, "customer_id", buckets, path=layout.path("customer_dimension"), fmt=layout.fmt)
    else:
        overwrite_table(rows, name, path=layout.path("customer_dimension"), fmt=layout.fmt)
    comment_on(spark, name, layout.comments["customer_dimension"])
    return spark.read.table(name)


def fixed_setting(spark: SparkSession, layout: Layout, name: str, value) -> None:
    """Keep a setting that the state of a checkpoint depends on; refuse another
    value in a later run."""
    folder = f"{layout.root}/settings"
    make_folder(spark, folder)
    kept = write_once(spark, f"{folder}/{name}.txt", str(value))
    if kept.strip() != str(value):
        raise ValueError(f"{name} was {kept.strip()} when the checkpoint was made and cannot become {value}")


class BatchTable:
    """A named table over folders written by ``foreachBatch`` (``batch_id`` first,
    ``event_date`` below it when by_date), made before its first batch."""

    def __init__(self, spark: SparkSession, layout: Layout, name: str, schema, by_date: bool):
        self.spark, self.table, self.path = spark, layout.table(name), layout.path(name)
        self.partition_by = ["batch_id"] + ["event_date"] * by_date
        fields = [f for f in schema.fields if f.name not in self.partition_by]
        fields += [f for n in self.partition_by for f in schema.fields if f.name == n]
        self.schema = T.StructType(fields)
        make_folder(spark, self.path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING {layout.fmt} "
                  f"PARTITIONED BY ({', '.join(self.partition_by)}) LOCATION '{self.path}'")
        if name in layout.comments:
            comment_on(spark, self.table, layout.comments[name])
        spark.catalog.recoverPartitions(self.table)

    def written(self, batch_id: int) -> None:
        """Make a batch's folders partitions of the table."""
        for spec in partition_specs(self.spark, self.path, f"batch_id={batch_id}", self.partition_by):
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION ({spec})")
        self.spark.catalog.refreshTable(self.table)

    def stream(self, layout: Layout) -> DataFrame:
        return self.spark.readStream.schema(self.schema).format(layout.fmt).load(self.path)


def _dated(df: DataFrame, name: str, by_date: bool) -> DataFrame:
    return df.withColumn("event_date", F.to_date(EVENT_TIME[name])) if by_date else df


def _high_value_refreshing(spark: SparkSession, layout: Layout, dim_table: str, now, hot_customers,
                           available_now: bool, processing_time: str | None):
    """``high_value_transaction_alert`` joined per micro-batch with the
    freshly refreshed dimension (for long-running jobs)."""
    name = "high_value_transaction_alert"
    by_date = layout.by_date and name in EVENT_TIME

    def build(batch: DataFrame, dim: DataFrame) -> DataFrame:
        return _dated(high_value_alerts(batch, dim, now, hot_customers=hot_customers), name, by_date)

    empty = spark.read.table(layout.table("silver_transactions")).limit(0)
    sample = build(empty, spark.read.table(dim_table)).withColumn("batch_id", F.lit(0).cast("long"))
    table = BatchTable(spark, layout, name, sample.schema, by_date)
    sink = RefreshingJoinWriter(dim_table, build, layout.path(name), ["event_date"] * by_date, table.written)
    q = stream_foreach_batch(layout.read_stream(spark, "silver_transactions"), sink,
                             layout.checkpoint(name), available_now=available_now,
                             processing_time=processing_time, query_name=layout.table(name))
    return (finish(q) if available_now else q), table.stream(layout)


#: Options of the watchlist match that the table-backed matcher has, too.
MATCHER_OPTIONS = ("max_lag", "watch_types", "statuses")


def _fraud_alerts_by_tables(spark: SparkSession, layout: Layout, dim_table: str, now, hot_customers,
                            card_buckets: int, options: dict, available_now: bool,
                            processing_time: str | None):
    """``fraud_card_alert`` from the table-backed matcher.  Each micro-batch
    re-reads the customer dimension (after a refresh), so a long-running job
    sees its updates."""
    name = "fraud_card_alert"
    refused = sorted(set(options) - set(MATCHER_OPTIONS))
    if refused:
        raise ValueError(f"the table-backed matcher has no {', '.join(refused)}; use watchlist_join=\"state\"")
    by_date = layout.by_date and name in EVENT_TIME
    fixed_setting(spark, layout, "card_buckets", card_buckets)

    def enrich(pairs: DataFrame) -> DataFrame:
        s = pairs.sparkSession
        s.catalog.refreshTable(dim_table)
        return _dated(enrich_matches(pairs, s.read.table(dim_table), now, hot_customers=hot_customers), name, by_date)

    # Layout of the alerts (analysis only, nothing runs).
    empty = watchlist_matches(spark.read.table(layout.table("silver_transactions")).limit(0),
                              spark.read.table(layout.table("silver_watchlist")).limit(0), watermark=None)
    table = BatchTable(spark, layout, name, enrich(empty).withColumn("batch_id", F.lit(0).cast("long")).schema, by_date)
    matcher = WatchlistMatcher(layout.path("watchlist_matcher"), card_buckets=card_buckets,
                               transform=enrich, out_path=layout.path(name),
                               out_partition_by=["event_date"] * by_date, written=table.written, **options)
    q = matcher.start(layout.read_stream(spark, "silver_transactions"), layout.read_stream(spark, "silver_watchlist"),
                      layout.checkpoint(name), available_now, processing_time)
    return (finish(q) if available_now else q), table.stream(layout)


BUCKET_BYTES = 128 * 1024 * 1024     # target size of one dimension bucket


def dimension_layout(spark: SparkSession, table: str, buckets) -> int | None:
    """Buckets for the published customer dimension: ``"auto"`` buckets it
    (about ``BUCKET_BYTES`` each) only when it is too large to broadcast."""
    if buckets != "auto":
        return buckets
    size = estimated_bytes(spark.read.table(table))
    if size is None or size <= BROADCAST_LIMIT_BYTES:
        return None
    return max(8, math.ceil(size / BUCKET_BYTES))


def run_graph(spark: SparkSession, layout: Layout, kafka: DataFrame, customers: DataFrame,
              watchlist_dir: str, available_now: bool = True, now: Column | None = None,
              processing_time: str | None = None, fraud_options: dict | None = None,
              notifications: bool = True, dimension_buckets: int | str | None = "auto",
              hot_customers: DataFrame | None = None, watchlist_join: str = "tables",
              card_buckets: int = 64, hot_share: float | None = None,
              hot_salt_buckets: int = 8, refresh_dimension: bool = False,
              latest_customers_only: bool = False) -> dict:
    """Start (or run to completion) every flow of the graph; returns the
    streaming queries by table name.

    ``latest_customers_only``: join with one row per customer instead of every
    row of ``silver_customers`` (the choice does not depend on any size).
    ``dimension_buckets``: publish the customer dimension as a bucketed table
    with that many buckets; ``"auto"`` does so only when it is too large to
    broadcast; ``hot_customers``: a bounded set of customer ids whose rows are
    spread (see ``heavy_hitters``).  Neither changes a result.
    ``watchlist_join``: ``"tables"`` (default) -- the pairs of the unbounded
    stream-stream join from ``WatchlistMatcher``, with the history in tables
    laid out by card bucket (``card_buckets``), so no join state grows with
    every transaction; ``"state"`` -- the stream-stream join itself (its state
    holds every transaction unless ``fraud_options["max_lag"]`` bounds it).
    ``hot_share``: find the customers (and, with ``watchlist_join="state"``, the
    cards) holding at least that share of the silver transactions (at most
    1/share of each; written once as small tables) and spread them; hot cards
    over ``hot_salt_buckets`` sub-keys, a count fixed by the first run.
    ``refresh_dimension``: join high-value alerts with the customer dimension
    refreshed for every micro-batch (a long-running job then sees updates
    written by other jobs); the tables-mode watchlist join always does, and so
    does every continuous run, which starts its alerts when the customers that
    are there have been read.
    """
    queries = {}
    ProgressLog.of(spark)

    def caught_up(name: str) -> None:
        """A continuous flow has read what its input holds so far."""
        if not available_now and name in queries:
            queries[name].processAllAvailable()

    def flow(name: str, df: DataFrame) -> None:
        partition_by = None
        if layout.by_date and name in EVENT_TIME:
            df = df.withColumn("event_date", F.to_date(EVENT_TIME[name]))
            partition_by = ["event_date"]
        if not available_now and name in QUALITY:
            observation, rules = QUALITY[name]
            record_while_running(spark, layout.table(name), observation, name, rules, layout.path("dq_metrics"))
        q = stream_to_table(df, layout.table(name), layout.checkpoint(name), fmt=layout.fmt,
                            path=layout.path(name), available_now=available_now,
                            processing_time=processing_time, partition_by=partition_by,
                            query_name=layout.table(name))
        queries[name] = finish(q) if available_now else q
        if name in layout.comments:
            comment_on(spark, layout.table(name), layout.comments[name])
        if available_now and name in QUALITY:
            observation, rules = QUALITY[name]
            record_quality(spark, q, observation, name, rules, layout.path("dq_metrics"))

    def read(name: str) -> DataFrame:
        return layout.read_stream(spark, name)

    flow("bronze_transactions", bronze_transactions(kafka, now))
    flow("silver_transactions", silver_transactions(read("bronze_transactions"), now))
    if customers.isStreaming:
        flow("silver_customers", silver_customers(customers, now))
    else:
        # a snapshot (e.g. a partitioned JDBC read): replace the table
        overwrite_table(silver_customers(customers, now), layout.table("silver_customers"),
                        path=layout.path("silver_customers"), fmt=layout.fmt)
    fraud_options = dict(fraud_options or {})
    if watchlist_join not in ("tables", "state"):
        raise ValueError("watchlist_join is \"tables\" or \"state\"")
    if hot_share:
        caught_up("bronze_transactions")
        caught_up("silver_transactions")
        history = spark.read.table(layout.table("silver_transactions"))
        heavy_hitters(history, "customer_id", hot_share).write.mode("overwrite").parquet(layout.path("hot_customers"))
        hot_customers = spark.read.parquet(layout.path("hot_customers"))
        if watchlist_join == "state":
            heavy_hitters(history.select(F.upper("card_number").alias("card")), "card", hot_share) \
                .write.mode("overwrite").parquet(layout.path("hot_cards"))
            fraud_options.setdefault("hot_cards", spark.read.parquet(layout.path("hot_cards")))
            fraud_options.setdefault("salt_buckets", hot_salt_buckets)
    flow("bronze_watchlist", stream_json_records(spark, watchlist_dir, WATCHLIST_RECORD, now,
                                                 max_files_per_trigger=layout.max_files_per_trigger))
    flow("silver_watchlist", silver_watchlist(read("bronze_watchlist"), now))
    caught_up("silver_customers")
    dimension_buckets = dimension_layout(spark, layout.table("silver_customers"), dimension_buckets)
    if dimension_buckets or latest_customers_only:
        dim = publish_customer_dimension(spark, layout, dimension_buckets, latest_customers_only)
        dim_table = layout.table("customer_dimension")
    else:
        dim_table = layout.table("silver_customers")
        dim = spark.read.table(dim_table)
    streams = {}
    if refresh_dimension or not available_now:
        q, streams["high_value_transaction_alert"] = _high_value_refreshing(
            spark, layout, dim_table, now, hot_customers, available_now, processing_time)
        queries["high_value_transaction_alert"] = q
    else:
        flow("high_value_transaction_alert", high_value_alerts(read("silver_transactions"), dim, now,
                                                               hot_customers=hot_customers))
    if watchlist_join == "tables":
        q, streams["fraud_card_alert"] = _fraud_alerts_by_tables(
            spark, layout, dim_table, now, hot_customers, card_buckets, fraud_options, available_now, processing_time)
        queries["fraud_card_alert"] = q
    else:
        fixed_setting(spark, layout, "salt_buckets", fraud_options.get("salt_buckets", 1))
        flow("fraud_card_alert", fraud_card_alerts(read("silver_transactions"), read("silver_watchlist"),
                                                   dim, now, hot_customers=hot_customers,
                                                   **fraud_options))
    flow("transactions_count_by_min", tumbling_counts(read("silver_transactions")))
    flow("transactions_count_by_min_sliding_window", sliding_counts(read("silver_transactions")))
    if notifications:
        for name, render in (("high_value_transaction_alert", render_high_value),
                             ("fraud_card_alert", render_fraud)):
            sink = OutboxWriter(layout.path(f"{name}_outbox"), render)
            source = streams[name] if name in streams else read(name)
            q = stream_foreach_batch(source, sink, layout.checkpoint(f"{name}_outbox"),
                                     available_now=available_now, processing_time=processing_time,
                                     query_name=layout.table(f"{name}_outbox"))
            queries[f"{name}_outbox"] = finish(q) if available_now else q
    return queries
