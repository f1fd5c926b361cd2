"""Every dataset and operator as a query over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the Spark job (a stream
with ``availableNow`` to a fresh folder where the dataset is a stream in the
application, a batch job otherwise) and returns its result;
``plans.oracle.oracles()[name]`` is DuckDB SQL over the same tables that must
give the same rows.  Columns made
from the clock (ingestion and alert times) are left out of compared results;
timestamps are returned without time zone, as DuckDB's are.
"""

from __future__ import annotations

import functools
import json
import math
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardsentry.operators.alerts import (enrich_matches, fraud_card_alerts, high_value_alerts,
                                         watchlist_matches)
from cardsentry.operators.joins import estimated_bytes, heavy_hitters
from cardsentry.operators.layers import (CUSTOMER_OBSERVATION, TRANSACTION_EXPECTATIONS,
                                         TRANSACTION_OBSERVATION, bronze_transactions, latest_customers,
                                         silver_customers, silver_transactions, silver_watchlist)
from cardsentry.operators.notify import (batch_summary, render_fraud, render_high_value,
                                         undeliverable, with_delivery_status)
from cardsentry.operators.quality import expectation_report, metrics_report
from cardsentry.operators.resume import unpublished
from cardsentry.operators.windows import sliding_counts, tumbling_counts
from cardsentry.plans.graph import Layout, run_graph
from cardsentry.plans.runs import DriverTables, Run
from cardsentry.schemas import WATCHLIST_RECORD
from cardsentry.sources import driver_tables as D
from cardsentry.sources.files import read_json_records, stream_json_records
from cardsentry.sources.schema_log import read_evolved, run_evolving
from cardsentry.sources.topic import read_topic, stream_topic, write_topic
from cardsentry.sources.tables import overwrite_table, scan, stream_scan, write_bucketed
from cardsentry.streaming.metrics import observed, progress_rows
from cardsentry.streaming.matcher import WatchlistMatcher
from cardsentry.streaming.outbox import OutboxWriter
from cardsentry.streaming.heavy import HeavyKeys
from cardsentry.streaming.keyed import keyed_matches
from cardsentry.streaming.late import keep_late_rows
from cardsentry.streaming.state import join_state
from cardsentry.streaming.sinks import drain, finish, stream_foreach_batch, stream_to_path, stream_to_table

# Fixed values of the scenarios.
FIXED_NOW = "timestamp'2024-02-01 00:00:00'"      # alert time in rendered messages
BOUNDED_LAG = "7 days"                             # watchlist_match_bounded
SALT_BUCKETS = 8                                   # watchlist_match_salted
HOT_SHARE = 0.0075                                 # high_value_alert_skew_split: share that makes a key hot
DIMENSION_BUCKETS = 8                              # high_value_alert_skew_split: buckets of the customer table
CARD_BUCKETS = 16                                  # watchlist_match_incremental: card buckets of the history
FIRST_DROP_BEFORE = "2024-02"                      # watchlist_match_incremental: months delivered first
MANY_FILES = 6                                     # dq_report_many_batches: micro-batches of the run
MATCH_STATUSES = ["ACTIVE"]                        # watchlist_match_filtered
PUBLISHED_BEFORE = "2024-02"                       # high_water_mark_slice: months already delivered
LATE_SPLIT = "2024-01-15 00:00:00"                 # late_rows_dropped: second drop holds the older rows; watchlist_match_ttl: the newer
TOPIC_START = 100                                  # kafka_offsets_resume: first offset wanted of partition 0
TOPIC_BATCHES = 5                                  # kafka_offsets_resume: bounded micro-batches of the first run
LATE_PARTITIONS = 4                                # late_rows_kept: the late half comes in partitions of its own
OUTBOX_DROPS = 4                                   # notification_outbox_repeated: drops, each with alerts of the one before
MATCH_DROPS = 6                                    # watchlist_match_compacted: micro-batches of the run
MERGE_FAN_IN = 2                                   # watchlist_match_compacted: segments merged into one
CLOCK_COLUMNS = {"ingesttime", "bronze_ingestion_ts", "silver_ingestion_ts", "ingestion_timestamp",
                 "bronze_ingestion_timestamp", "silver_ingestion_timestamp", "alert_ts",
                 "alert_timestamp", "source_file"}


def comparable(df: DataFrame) -> DataFrame:
    """Drop clock columns; timestamps to TIMESTAMP_NTZ."""
    cols = []
    for f in df.schema.fields:
        if f.name in CLOCK_COLUMNS:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Runtime SQL settings for the duration of a block."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Bytes of operator state one partition should hold, and how much larger the
# rows are in state than in compressed parquet (rough).
STATE_PARTITION_BYTES = 64 * 1024 * 1024
STATE_EXPANSION = 10


def state_partitions(spark: SparkSession, sf_dir: str) -> int:
    """State partitions for the stateful streams of a run: as many as the
    input needs at ``STATE_PARTITION_BYTES`` each, at least one per task slot,
    at most the session's ``spark.sql.shuffle.partitions``.  (Stateful
    operators keep the count of their first run in the checkpoint; AQE does
    not resize them.)"""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")) or 0
    wanted = max(spark.sparkContext.defaultParallelism,
                 math.ceil(size * STATE_EXPANSION / STATE_PARTITION_BYTES))
    return min(configured, wanted)


def sized(fn):
    """Run a catalog query with state partitions sized to its input."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with session_conf(spark, {"spark.sql.shuffle.partitions": str(state_partitions(spark, sf_dir))}):
            return fn(spark, sf_dir)
    return run


# --- shared inputs --------------------------------------------------------

def kafka_batch(src: DriverTables) -> DataFrame:
    """Replayed Kafka records (batch); the scan's splits give the parallelism."""
    return D.kafka_records(src.table("events"), src.table("nation"))


def bronze_batch(run: Run, src: DriverTables) -> DataFrame:
    """Bronze transactions as a written table of the run (as in the graph:
    bronze is a table, silver reads it)."""
    path = run.path("bronze_transactions")
    bronze_transactions(kafka_batch(src)).write.parquet(path)
    return run.spark.read.parquet(path)


def kafka_stream(src: DriverTables) -> DataFrame:
    """Replayed Kafka records as a stream.  The scan's splits give the
    parallelism, as a topic's partitions (or ``minPartitions``) would; nothing
    is shuffled to spread them."""
    return D.kafka_records(src.stream("events"), src.table("nation"))


def customers_dim(run: Run, src: DriverTables) -> DataFrame:
    """Silver customers (static dimension) as a written table of the run, so
    that its size estimate is its file size (what the broadcast check reads)."""
    path = run.path("silver_customers")
    silver_customers(D.customer_records(src.table("customer"), src.table("nation")),
                     observation=None).write.parquet(path)
    return run.spark.read.parquet(path)


def watchlist_feed(run: Run, src: DriverTables, by: str | None = None) -> str:
    path = run.path("watchlist_feed")
    D.write_watchlist_feed(src.table("customer"), src.table("nation"), path, by)
    return path


def silver_tx_stream(src: DriverTables) -> DataFrame:
    return silver_transactions(bronze_transactions(kafka_stream(src)))


def silver_wl_stream(run: Run, src: DriverTables) -> DataFrame:
    feed = watchlist_feed(run, src)
    return silver_watchlist(stream_json_records(run.spark, feed, WATCHLIST_RECORD))


# --- sources and sinks ----------------------------------------------------

def q_kafka_envelope_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    Run(spark, "kafka_envelope_batch")
    return comparable(bronze_transactions(kafka_batch(DriverTables(spark, sf_dir))))


def q_message_count(spark, sf_dir):
    Run(spark, "message_count")
    return kafka_batch(DriverTables(spark, sf_dir)).agg(F.count(F.lit(1)).alias("messages"))


def q_bronze_transactions(spark, sf_dir):
    run = Run(spark, "bronze_transactions")
    out = run.materialize(bronze_transactions(kafka_stream(DriverTables(spark, sf_dir))))
    return comparable(out)


def q_batch_overwrite(spark, sf_dir):
    run = Run(spark, "batch_overwrite")
    src = DriverTables(spark, sf_dir)
    table = f"fraud_bronze_batch_{run.root.rsplit('-', 1)[-1]}"
    bronze = bronze_transactions(kafka_batch(src))
    for _ in range(2):      # a second overwrite must not add rows
        overwrite_table(bronze, table, path=run.path(table))
    return comparable(spark.table(table))


def q_table_scan(spark, sf_dir):
    run = Run(spark, "table_scan")
    src = DriverTables(spark, sf_dir)
    table = f"fraud_silver_customers_{run.root.rsplit('-', 1)[-1]}"
    dim = silver_customers(D.customer_records(src.table("customer"), src.table("nation")), observation=None)
    overwrite_table(dim, table, path=run.path(table))
    return comparable(scan(spark, table))


def q_bronze_watchlist(spark, sf_dir):
    run = Run(spark, "bronze_watchlist")
    src = DriverTables(spark, sf_dir)
    out = run.materialize(stream_json_records(spark, watchlist_feed(run, src), WATCHLIST_RECORD))
    return comparable(out)


def q_rescued_data(spark, sf_dir):
    run = Run(spark, "rescued_data")
    src = DriverTables(spark, sf_dir)
    rows = read_json_records(spark, watchlist_feed(run, src), WATCHLIST_RECORD)
    return rows.where(F.col("_rescued_data").isNotNull()).select("watchlist_id", "_rescued_data")


def q_file_lineage(spark, sf_dir):
    run = Run(spark, "file_lineage")
    src = DriverTables(spark, sf_dir)
    feed = watchlist_feed(run, src, D.WATCHLIST_DROP)      # the folders' names are the result
    bronze = run.materialize(stream_json_records(spark, feed, WATCHLIST_RECORD))
    drop = F.regexp_extract("source_file", f"{D.WATCHLIST_DROP}=([^/]+)/", 1)
    return bronze.groupBy(drop.alias(D.WATCHLIST_DROP)).agg(F.count(F.lit(1)).alias("records"))


def q_high_water_mark_slice(spark, sf_dir):
    run = Run(spark, "high_water_mark_slice")
    src = DriverTables(spark, sf_dir)
    lines = D.watchlist_lines(src.table("customer"), src.table("nation"))
    published_dir, source_dir, slice_dir = (run.path("published"), run.path("source"), run.path("slice"))
    D.write_feed(lines.where(F.col(D.WATCHLIST_DROP) < F.lit(PUBLISHED_BEFORE)), published_dir)
    D.write_feed(lines, source_dir)
    published = read_json_records(spark, published_dir, WATCHLIST_RECORD)
    source = read_json_records(spark, source_dir, WATCHLIST_RECORD)
    todo = unpublished(source, published).select(*WATCHLIST_RECORD.fieldNames())
    todo.write.mode("append").json(slice_dir)
    return spark.read.schema(WATCHLIST_RECORD).json(slice_dir)


def q_high_water_mark_empty(spark, sf_dir):
    """Nothing published yet: everything is to be published, unreadable ids too."""
    run = Run(spark, "high_water_mark_empty")
    src = DriverTables(spark, sf_dir)
    source = read_json_records(spark, watchlist_feed(run, src), WATCHLIST_RECORD)
    return unpublished(source, source.limit(0)).select(*WATCHLIST_RECORD.fieldNames(), "_rescued_data")


def q_inferred_schema_stream(spark, sf_dir):
    """The feed as a stream whose schema was inferred from its files and stored."""
    run = Run(spark, "inferred_schema_stream")
    src = DriverTables(spark, sf_dir)
    stream = stream_json_records(spark, watchlist_feed(run, src), schema_location=run.path("schema"))
    return comparable(run.materialize(stream))


def q_rescued_data_typed(spark, sf_dir):
    """A typed schema: a value of another type goes to ``_rescued_data``."""
    run = Run(spark, "rescued_data_typed")
    src = DriverTables(spark, sf_dir)
    schema = T.StructType([T.StructField(f.name, T.LongType() if f.name == "reason_code" else f.dataType)
                           for f in WATCHLIST_RECORD.fields])
    rows = read_json_records(spark, watchlist_feed(run, src), schema)
    return rows.select("watchlist_id", "entity_id", "reason_code", "_rescued_data")


def q_stream_table_roundtrip(spark, sf_dir):
    run = Run(spark, "stream_table_roundtrip")
    src = DriverTables(spark, sf_dir)
    layout = Layout(run.root, prefix=f"fraud_{run.root.rsplit('-', 1)[-1]}")
    customers = D.customer_records(src.stream("customer"), src.table("nation"))
    run_graph(spark, layout, kafka_stream(src), customers, watchlist_feed(run, src), notifications=False,
              dimension_buckets=DIMENSION_BUCKETS)
    counts = None
    for name, columns in ROUNDTRIP_COLUMNS.items():
        text = F.concat_ws("|", *[F.coalesce(_plain_text(spark.table(layout.table(name)), c), F.lit("~")) for c in columns])
        one = spark.table(layout.table(name)).agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")).alias("checksum")) \
            .select(F.lit(name).alias("table_name"), "records", "checksum")
        counts = one if counts is None else counts.unionByName(one)
    return counts


# Columns whose values stream_table_roundtrip compares, beside the row counts.
ROUNDTRIP_COLUMNS = {
    "bronze_transactions": ["value", "topic", "partition", "offset", "timestamp"],
    "silver_transactions": ["transaction_id", "customer_id", "card_number", "merchant_name", "country",
                            "transaction_timestamp", "kafka_offset"],
    "silver_customers": ["customer_id", "last_name", "country", "account_open_date", "email"],
    "bronze_watchlist": ["watchlist_id", "entity_id", "risk_level", "effective_from", "_rescued_data"],
    "silver_watchlist": ["watchlist_id", "entity_id", "risk_level", "action", "effective_from", "city"],
    "high_value_transaction_alert": ["alert_id", "customer_id", "customer_email", "customer_name", "transaction_timestamp"],
    "fraud_card_alert": ["alert_id", "customer_id", "customer_email", "risk_level", "watchlist_effective_from"],
    "transactions_count_by_min": ["window_start", "window_end", "transactions_count"],
    "transactions_count_by_min_sliding_window": ["window_start", "window_end", "transactions_count"],
}


def _plain_text(df: DataFrame, column: str):
    kind = df.schema[column].dataType
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss") if isinstance(kind, T.TimestampType) else F.col(column).cast("string")


def q_kafka_offsets_resume(spark, sf_dir):
    """The topic as a stream with offsets: half of it is delivered, read in bounded
    micro-batches from given starting offsets, and the query is stopped; then the
    rest is delivered and the query started again, with starting offsets that no
    longer matter.  Every (partition, offset) arrives once."""
    run = Run(spark, "kafka_offsets_resume")
    records = kafka_batch(DriverTables(spark, sf_dir))
    middle = records.agg(F.floor(F.max("offset") / 2)).first()[0]
    topic, out, checkpoint = run.path("topic"), run.path("out"), run.checkpoint("out")
    limit = max(1, int(middle) // TOPIC_BATCHES)
    for half, start in ((F.col("offset") <= middle, f'{{"{D.KAFKA_TOPIC}": {{"0": {TOPIC_START}}}}}'),
                        (F.col("offset") > middle, "latest")):
        write_topic(records.where(half), topic)
        stream = stream_topic(spark, topic, D.KAFKA_TOPIC, start, max_offsets_per_trigger=limit, checkpoint=checkpoint)
        run.queries.append(drain(stream, out, checkpoint))
    return (spark.read.parquet(out).groupBy("partition", "offset")
            .agg(F.count(F.lit(1)).alias("copies"), F.max(F.col("value").cast("string")).alias("value"),
                 F.max(F.col("timestamp").cast("timestamp_ntz")).alias("timestamp")))


def q_schema_evolution_stream(spark, sf_dir):
    """The watchlist feed whose later files hold a field that the schema, inferred
    from the first ones, does not know."""
    run = Run(spark, "schema_evolution_stream")
    src = DriverTables(spark, sf_dir)
    lines = D.watchlist_lines(src.table("customer"), src.table("nation"))
    extra, feed = D.WATCHLIST_EXTRA_FIELD[0], run.path("watchlist_feed")
    later = F.contains("value", F.lit(f'"{extra}"'))
    for part in (~later, later):
        D.write_feed(lines.where(part), feed)
        run_evolving(spark, feed, run.path("schema"), run.path("out"), run.checkpoint("out"))
    return read_evolved(spark, run.path("schema"), run.path("out")).select(*WATCHLIST_RECORD.fieldNames(), extra, "_rescued_data")


# --- silver and data quality ----------------------------------------------

def q_silver_transactions(spark, sf_dir):
    run = Run(spark, "silver_transactions")
    return comparable(run.materialize(silver_tx_stream(DriverTables(spark, sf_dir))))


def q_dq_drop(spark, sf_dir):
    run = Run(spark, "dq_drop")
    silver = silver_transactions(bronze_batch(run, DriverTables(spark, sf_dir)), observation=None)
    return silver.select("kafka_offset", "transaction_id", "customer_id", "card_number", "amount")


def _parsed_batch(run: Run, src: DriverTables) -> DataFrame:
    return silver_transactions(bronze_batch(run, src), expectations=[], observation=None)


def q_dq_warn_counts(spark, sf_dir):
    run = Run(spark, "dq_warn_counts")
    return expectation_report(_parsed_batch(run, DriverTables(spark, sf_dir)), TRANSACTION_EXPECTATIONS)


def q_dq_report(spark, sf_dir):
    run = Run(spark, "dq_report")
    run.materialize(silver_tx_stream(DriverTables(spark, sf_dir)))
    metrics = observed(run.queries[-1], TRANSACTION_OBSERVATION)
    return spark.createDataFrame(metrics_report(metrics, TRANSACTION_EXPECTATIONS),
                                 "expectation string, action string, passed_records long, failed_records long")


def q_dq_report_many_batches(spark, sf_dir):
    """The report of a run of many micro-batches: every batch counts, however
    many reports the session keeps."""
    run = Run(spark, "dq_report_many_batches")
    src = DriverTables(spark, sf_dir)
    events = src.table("events")
    drops = run.path("event_files")
    slot = F.pmod(F.xxhash64("event_id"), F.lit(MANY_FILES)).cast("int")
    events.withColumn("slot", slot).repartition("slot").write.partitionBy("slot").parquet(drops)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(drops)
    run.materialize(silver_transactions(bronze_transactions(D.kafka_records(stream, src.table("nation")))))
    assert len(progress_rows(run.queries[-1])) >= MANY_FILES
    metrics = observed(run.queries[-1], TRANSACTION_OBSERVATION)
    return spark.createDataFrame(metrics_report(metrics, TRANSACTION_EXPECTATIONS),
                                 "expectation string, action string, passed_records long, failed_records long")


def q_customer_versions(spark, sf_dir):
    """High-value alerts against a dimension that holds two versions of every
    customer, joined with all rows and with the latest ones, broadcast and
    shuffled: the layout must not change the answer."""
    run = Run(spark, "customer_versions")
    src = DriverTables(spark, sf_dir)
    versions = customers_dim(run, src)
    older = versions.withColumns({"transaction_limit": F.col("transaction_limit") / 2,
                                  "silver_ingestion_timestamp": F.expr("timestamp'2020-01-01 00:00:00'")})
    path = run.path("customer_versions")
    versions.unionByName(older).write.parquet(path)
    both = spark.read.parquet(path)
    silver = silver_transactions(bronze_batch(run, src), observation=None)
    heavy_hitters(silver, "customer_id", HOT_SHARE).write.parquet(run.path("hot_customers"))
    hot = spark.read.parquet(run.path("hot_customers"))
    out = None
    for rule, dim in (("all", both), ("latest", latest_customers(both))):
        for layout, limit in (("broadcast", 1 << 30), ("shuffled", 0)):
            one = high_value_alerts(silver, dim, broadcast_limit_bytes=limit, hot_customers=hot) \
                .select(F.lit(rule).alias("rule"), F.lit(layout).alias("layout"), "alert_id", "transaction_limit")
            out = one if out is None else out.unionByName(one)
    return out


def q_silver_customers(spark, sf_dir):
    run = Run(spark, "silver_customers")
    src = DriverTables(spark, sf_dir)
    stream = silver_customers(D.customer_records(src.stream("customer"), src.table("nation")),
                              observation=CUSTOMER_OBSERVATION)
    return comparable(run.materialize(stream))


def q_silver_watchlist(spark, sf_dir):
    run = Run(spark, "silver_watchlist")
    return comparable(run.materialize(silver_wl_stream(run, DriverTables(spark, sf_dir))))


# --- gold -------------------------------------------------------------------

def q_high_value_alert(spark, sf_dir):
    run = Run(spark, "high_value_alert")
    src = DriverTables(spark, sf_dir)
    return comparable(run.materialize(high_value_alerts(silver_tx_stream(src), customers_dim(run, src))))


def q_high_value_alert_skew_split(spark, sf_dir):
    """High-value alerts with the customer dimension too large to broadcast:
    published as a table bucketed by customer_id (latest row per customer);
    the rows of customers holding at least HOT_SHARE of the landed transactions
    are spread over sub-keys, in one join."""
    run = Run(spark, "high_value_alert_skew_split")
    src = DriverTables(spark, sf_dir)
    table = f"fraud_customer_dim_{run.root.rsplit('-', 1)[-1]}"
    write_bucketed(latest_customers(customers_dim(run, src)), table, "customer_id", DIMENSION_BUCKETS,
                   path=run.path(table))
    history = silver_transactions(bronze_batch(run, src), observation=None)
    # Written once: otherwise every micro-batch would re-aggregate the history.
    heavy_hitters(history, "customer_id", HOT_SHARE).write.parquet(run.path("hot_customers"))
    hot = spark.read.parquet(run.path("hot_customers"))
    alerts = high_value_alerts(silver_tx_stream(src), spark.table(table), broadcast_limit_bytes=0,
                               hot_customers=hot)
    # The test dimension is small; keep the planner from broadcasting it so
    # that the run takes the path a large dimension takes.
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        return comparable(run.materialize(alerts))


def q_heavy_customers(spark, sf_dir):
    """Customers that hold HOT_SHARE of the transactions: candidates from the summary
    that the stream's micro-batches keep, confirmed by counting these keys alone."""
    run = Run(spark, "heavy_customers")
    src = DriverTables(spark, sf_dir)
    events, drops = src.table("events"), run.path("event_files")
    slot = F.pmod(F.xxhash64("event_id"), F.lit(MANY_FILES)).cast("int")
    events.withColumn("slot", slot).repartition("slot").write.partitionBy("slot").parquet(drops)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(drops)
    silver = silver_transactions(bronze_transactions(D.kafka_records(stream, src.table("nation"))))
    heavy = HeavyKeys(run.path("heavy"), "customer_id", capacity=round(2 / HOT_SHARE))
    run.queries.append(finish(stream_foreach_batch(silver, heavy, run.checkpoint("heavy"))))
    history = silver_transactions(bronze_batch(run, src), observation=None)
    rows = heavy.summary(spark).agg(F.max("rows")).first()[0]
    few = F.broadcast(heavy.candidates(spark, HOT_SHARE))        # at most the summary's capacity
    return (history.join(few, "customer_id").groupBy("customer_id").agg(F.count(F.lit(1)).alias("transactions"))
            .where(F.col("transactions") >= F.lit(HOT_SHARE) * rows))


MATCH_COLUMNS = ["transaction_id", "watchlist_id", "card_number", "amount", "transaction_timestamp",
                 "effective_from", "risk_level"]


def _matches(spark, sf_dir, label, **options):
    run = Run(spark, label)
    src = DriverTables(spark, sf_dir)
    m = watchlist_matches(silver_tx_stream(src), silver_wl_stream(run, src), **options)
    return comparable(run.materialize(m.select(*MATCH_COLUMNS)))


def q_watchlist_match(spark, sf_dir):
    return _matches(spark, sf_dir, "watchlist_match")


def q_watchlist_match_bounded(spark, sf_dir):
    return _matches(spark, sf_dir, "watchlist_match_bounded", max_lag=BOUNDED_LAG)


def q_watchlist_match_ttl(spark, sf_dir):
    """The bounded match by keyed state with timers.  Transactions arrive in two
    drops, so that state of the first expires while the second is matched."""
    run = Run(spark, "watchlist_match_ttl")
    src = DriverTables(spark, sf_dir)
    days, amount = BOUNDED_LAG.split()
    feed, events, drops = watchlist_feed(run, src), src.table("events"), run.path("event_files")
    early = F.col("ts") < F.lit(LATE_SPLIT).cast(events.schema["ts"].dataType)
    for k, part in enumerate((early | F.col("ts").isNull(), ~early)):
        events.where(part).write.parquet(f"{drops}/drop={k}")
        stream = spark.readStream.schema(events.schema).parquet(drops).drop("drop")
        txns = silver_transactions(bronze_transactions(D.kafka_records(stream, src.table("nation"))))
        wl = silver_watchlist(stream_json_records(spark, feed, WATCHLIST_RECORD))
        pairs = keyed_matches(txns, wl, timedelta(**{amount: int(days)}))
        out = run.materialize(pairs.select(*MATCH_COLUMNS))
    return comparable(out)


def q_watchlist_match_salted(spark, sf_dir):
    return _matches(spark, sf_dir, "watchlist_match_salted", salt_buckets=SALT_BUCKETS)


def q_watchlist_match_incremental(spark, sf_dir):
    """The unbounded match with its history in tables (WatchlistMatcher).
    The watchlist arrives in two drops: January's entries with all
    transactions, then the later entries, which are matched against the
    transaction history."""
    run = Run(spark, "watchlist_match_incremental")
    src = DriverTables(spark, sf_dir)
    lines = D.watchlist_lines(src.table("customer"), src.table("nation"))
    feed = run.path("watchlist_feed")
    matcher = WatchlistMatcher(run.path("matcher"), card_buckets=CARD_BUCKETS)
    for part in (F.col(D.WATCHLIST_DROP) < F.lit(FIRST_DROP_BEFORE),
                 F.col(D.WATCHLIST_DROP) >= F.lit(FIRST_DROP_BEFORE)):
        D.write_feed(lines.where(part), feed)
        wl = silver_watchlist(stream_json_records(spark, feed, WATCHLIST_RECORD))
        run.queries.append(finish(matcher.start(silver_tx_stream(src), wl, run.checkpoint("matcher"))))
    return comparable(matcher.matches(spark).select(*MATCH_COLUMNS))


def q_watchlist_match_filtered(spark, sf_dir):
    """Only entries of one status, by both ways to match."""
    run = Run(spark, "watchlist_match_filtered")
    src = DriverTables(spark, sf_dir)
    wl = silver_wl_stream(run, src)
    joined = run.materialize(watchlist_matches(silver_tx_stream(src), wl, statuses=MATCH_STATUSES).select(*MATCH_COLUMNS))
    matcher = WatchlistMatcher(run.path("matcher"), card_buckets=CARD_BUCKETS, statuses=MATCH_STATUSES)
    run.queries.append(finish(matcher.start(silver_tx_stream(src), wl, run.checkpoint("matcher"))))
    both = [df.select(F.lit(way).alias("way"), *MATCH_COLUMNS)
            for way, df in (("state", joined), ("tables", matcher.matches(spark)))]
    return comparable(both[0].unionByName(both[1]))


def _fraud_alert_stream(run: Run, src: DriverTables, now=None) -> DataFrame:
    return fraud_card_alerts(silver_tx_stream(src), silver_wl_stream(run, src), customers_dim(run, src), now)


def _fraud_alerts_matched(run: Run, src: DriverTables, now=None) -> DataFrame:
    """Fraud-card alerts as the graph makes them: the matcher's pairs of every
    micro-batch, enriched with the customers."""
    dim = customers_dim(run, src)
    matcher = WatchlistMatcher(run.path("matcher"), card_buckets=CARD_BUCKETS,
                               transform=lambda pairs: enrich_matches(pairs, dim, now))
    run.queries.append(finish(matcher.start(silver_tx_stream(src), silver_wl_stream(run, src), run.checkpoint("matcher"))))
    return matcher.matches(run.spark).drop("batch_id")


def q_fraud_card_alert(spark, sf_dir):
    run = Run(spark, "fraud_card_alert")
    return comparable(_fraud_alerts_matched(run, DriverTables(spark, sf_dir)))


def q_fraud_card_alert_state(spark, sf_dir):
    """The same alerts from the stream-stream join, which keeps every transaction in state."""
    run = Run(spark, "fraud_card_alert_state")
    return comparable(run.materialize(_fraud_alert_stream(run, DriverTables(spark, sf_dir))))


def q_tumbling_counts(spark, sf_dir):
    run = Run(spark, "tumbling_counts")
    return comparable(run.materialize(tumbling_counts(silver_tx_stream(DriverTables(spark, sf_dir)))))


def q_sliding_counts(spark, sf_dir):
    run = Run(spark, "sliding_counts")
    return comparable(run.materialize(sliding_counts(silver_tx_stream(DriverTables(spark, sf_dir)))))


def q_late_rows_dropped(spark, sf_dir):
    """Events arrive in two drops; the second holds only rows older than the
    watermark reached after the first, so none of them may be counted."""
    run = Run(spark, "late_rows_dropped")
    src = DriverTables(spark, sf_dir)
    events = src.table("events")
    drops = run.path("event_drops")
    split = F.col("ts") >= F.lit(LATE_SPLIT).cast("timestamp_ntz")
    counts_path, ckpt = run.path("counts"), run.checkpoint("counts")
    progress = []
    for i, part in enumerate([events.where(split), events.where(~split)]):
        part.write.mode("append").parquet(f"{drops}/drop={i}")
        stream = src.spark.readStream.schema(events.schema).parquet(drops)
        counts = tumbling_counts(silver_transactions(bronze_transactions(
            D.kafka_records(stream.drop("drop"), src.table("nation")))))
        q = finish(stream_to_path(counts, counts_path, ckpt))
        progress += progress_rows(q)
    dropped = sum(r[2] for r in progress)
    inputs = sum(r[1] for r in progress)
    return (spark.read.parquet(counts_path)
            .agg(F.count(F.lit(1)).alias("windows_emitted"),
                 F.sum("transactions_count").alias("transactions_counted"))
            .select("windows_emitted", "transactions_counted",
                    F.lit(inputs).cast("long").alias("input_rows"),
                    F.lit(dropped > 0).alias("late_rows_dropped")))


def q_late_rows_kept(spark, sf_dir):
    """As ``late_rows_dropped``, from a topic, with the dropped rows set aside: the
    count's checkpoint tells the offsets and the watermark of each micro-batch."""
    run = Run(spark, "late_rows_kept")
    src = DriverTables(spark, sf_dir)
    records = kafka_batch(src)
    split = F.col("timestamp") >= F.lit(LATE_SPLIT).cast("timestamp")
    topic, counts_path, ckpt = run.path("topic"), run.path("counts"), run.checkpoint("counts")
    parsed = lambda rows: silver_transactions(bronze_transactions(rows), observation=None)
    for late in (False, True):
        part = records.where(~split if late else split)
        # offsets of a partition only grow: what comes late comes in other partitions
        write_topic(part.withColumn("partition", F.col("partition") + (LATE_PARTITIONS if late else 0)), topic)
        counts = tumbling_counts(parsed(stream_topic(spark, topic, D.KAFKA_TOPIC)))
        run.queries.append(drain(counts, counts_path, ckpt))
    keep_late_rows(spark, ckpt, lambda start, end: parsed(read_topic(
        spark, topic, D.KAFKA_TOPIC, json.dumps(start), json.dumps(end))), run.path("late"))
    late = spark.read.parquet(run.path("late"))
    return late.select("transaction_id", "kafka_partition", "kafka_offset",
                       F.col("transaction_timestamp").cast("timestamp_ntz").alias("transaction_timestamp"),
                       F.col("late_watermark").cast("timestamp_ntz").alias("late_watermark"))


def q_join_state_rows(spark, sf_dir):
    """What the stream-stream join remembers, read from its state store: rows of each
    side by card."""
    run = Run(spark, "join_state_rows")
    src = DriverTables(spark, sf_dir)
    run.materialize(watchlist_matches(silver_tx_stream(src), silver_wl_stream(run, src)).select(*MATCH_COLUMNS))
    state = join_state(spark, run.checkpoint("out"))
    return state.groupBy("side", F.col("join_key").alias("card_number")).agg(F.sum("rows").alias("state_rows"))


def q_watchlist_match_compacted(spark, sf_dir):
    """The matcher over several micro-batches, with the segments of its history merged
    between them."""
    run = Run(spark, "watchlist_match_compacted")
    src = DriverTables(spark, sf_dir)
    drops, lines = run.path("event_files"), D.watchlist_lines(src.table("customer"), src.table("nation"))
    events, feed = src.table("events"), run.path("watchlist_feed")
    slot = F.pmod(F.xxhash64("event_id"), F.lit(MATCH_DROPS)).cast("int")
    matcher = WatchlistMatcher(run.path("matcher"), card_buckets=CARD_BUCKETS, fan_in=MERGE_FAN_IN)
    for k in range(MATCH_DROPS):
        events.where(slot == k).write.parquet(f"{drops}/drop={k}")
        D.write_feed(lines.where(F.pmod(F.xxhash64("value"), F.lit(MATCH_DROPS)) == k), feed)
        stream = spark.readStream.schema(events.schema).parquet(drops)
        txns = silver_transactions(bronze_transactions(D.kafka_records(stream.drop("drop"), src.table("nation"))))
        wl = silver_watchlist(stream_json_records(spark, feed, WATCHLIST_RECORD))
        run.queries.append(finish(matcher.start(txns, wl, run.checkpoint("matcher"))))
    assert len(matcher.tx.segments(spark)) < MATCH_DROPS and len(matcher.wl.segments(spark)) < MATCH_DROPS
    return comparable(matcher.matches(spark).select(*MATCH_COLUMNS))


# --- notifications ----------------------------------------------------------

def _batch_high_value(run: Run, src: DriverTables) -> DataFrame:
    silver = silver_transactions(bronze_batch(run, src), observation=None)
    return high_value_alerts(silver, customers_dim(run, src), F.expr(FIXED_NOW))


def _batch_fraud(run: Run, src: DriverTables) -> DataFrame:
    silver = silver_transactions(bronze_batch(run, src), observation=None)
    wl = silver_watchlist(read_json_records(run.spark, watchlist_feed(run, src), WATCHLIST_RECORD),
                          observation=None)
    return fraud_card_alerts(silver, wl, customers_dim(run, src), F.expr(FIXED_NOW), watermark=None)


RENDER_COLUMNS = ["alert_id", "alert_type", "recipient", "subject", "body_html"]


def q_render_high_value_notification(spark, sf_dir):
    run = Run(spark, "render_high_value")
    return render_high_value(_batch_high_value(run, DriverTables(spark, sf_dir))).select(*RENDER_COLUMNS)


def q_render_fraud_notification(spark, sf_dir):
    run = Run(spark, "render_fraud")
    return render_fraud(_batch_fraud(run, DriverTables(spark, sf_dir))).select(*RENDER_COLUMNS)


def q_notification_undeliverable(spark, sf_dir):
    run = Run(spark, "notification_undeliverable")
    rendered = render_fraud(_batch_fraud(run, DriverTables(spark, sf_dir)))
    return undeliverable(with_delivery_status(rendered)).select("alert_id", "alert_type", "status")


def q_notification_outbox_high_value(spark, sf_dir):
    """High-value alerts straight into their outbox."""
    run = Run(spark, "notification_outbox_high_value")
    src = DriverTables(spark, sf_dir)
    alerts = high_value_alerts(silver_tx_stream(src), customers_dim(run, src), F.expr(FIXED_NOW))
    path = run.path("outbox")
    run.queries.append(finish(stream_foreach_batch(alerts, OutboxWriter(path, render_high_value), run.checkpoint("outbox"))))
    return spark.read.parquet(path).select("alert_id", "alert_type", "recipient", "status", "subject")


def q_notification_table_flow(spark, sf_dir):
    """Append flow from a named alert table into its outbox."""
    run = Run(spark, "notification_table_flow")
    src = DriverTables(spark, sf_dir)
    table = f"fraud_alerts_{run.root.rsplit('-', 1)[-1]}"
    alerts = _fraud_alert_stream(run, src, F.expr(FIXED_NOW))
    run.queries.append(finish(stream_to_table(alerts, table, run.checkpoint("alerts"), path=run.path("alerts"))))
    path = run.path("outbox")
    run.queries.append(finish(stream_foreach_batch(stream_scan(spark, table), OutboxWriter(path, render_fraud),
                                                   run.checkpoint("outbox"))))
    return spark.read.parquet(path).select("alert_id", "alert_type", "recipient", "status", "subject", "body_html")


def _outbox(spark, sf_dir, label):
    run = Run(spark, label)
    src = DriverTables(spark, sf_dir)
    alerts = _fraud_alert_stream(run, src, F.expr(FIXED_NOW))
    path = run.path("outbox")
    run.queries.append(finish(stream_foreach_batch(alerts, OutboxWriter(path, render_fraud),
                                                   run.checkpoint("outbox"))))
    return spark.read.parquet(path)


def q_notification_outbox(spark, sf_dir):
    return _outbox(spark, sf_dir, "notification_outbox").select(
        "alert_id", "alert_type", "recipient", "status", "subject")


def q_notification_outbox_repeated(spark, sf_dir):
    """Alerts delivered in several drops, each with all alerts of the drop before once
    more: one message per alert, from the drop that brought it first."""
    run = Run(spark, "notification_outbox_repeated")
    alerts_path, drops = run.path("alerts"), run.path("alert_drops")
    _batch_fraud(run, DriverTables(spark, sf_dir)).write.parquet(alerts_path)
    alerts = spark.read.parquet(alerts_path)
    slot = F.conv(F.substring(F.md5("alert_id"), 1, 4), 16, 10).cast("long") % OUTBOX_DROPS
    sink = OutboxWriter(run.path("outbox"), render_fraud, fan_in=MERGE_FAN_IN)
    for k in range(OUTBOX_DROPS):
        alerts.where(slot.isin(k, max(k - 1, 0))).write.parquet(f"{drops}/drop={k}")
        stream = spark.readStream.schema(alerts.schema).parquet(drops).drop("drop")
        run.queries.append(finish(stream_foreach_batch(stream, sink, run.checkpoint("outbox"))))
    return spark.read.parquet(run.path("outbox")).select("alert_id", "recipient", "status", F.col("batch_id").cast("long").alias("drop"))


def q_notification_batch_summary(spark, sf_dir):
    return batch_summary(_outbox(spark, sf_dir, "notification_batch_summary"))


QUERIES = {k: sized(v) for k, v in {
    "kafka_envelope_batch": q_kafka_envelope_batch,
    "message_count": q_message_count,
    "bronze_transactions": q_bronze_transactions,
    "batch_overwrite": q_batch_overwrite,
    "table_scan": q_table_scan,
    "bronze_watchlist": q_bronze_watchlist,
    "rescued_data": q_rescued_data,
    "file_lineage": q_file_lineage,
    "kafka_offsets_resume": q_kafka_offsets_resume,
    "schema_evolution_stream": q_schema_evolution_stream,
    "high_water_mark_slice": q_high_water_mark_slice,
    "high_water_mark_empty": q_high_water_mark_empty,
    "inferred_schema_stream": q_inferred_schema_stream,
    "rescued_data_typed": q_rescued_data_typed,
    "stream_table_roundtrip": q_stream_table_roundtrip,
    "silver_transactions": q_silver_transactions,
    "dq_drop": q_dq_drop,
    "dq_warn_counts": q_dq_warn_counts,
    "dq_report": q_dq_report,
    "dq_report_many_batches": q_dq_report_many_batches,
    "customer_versions": q_customer_versions,
    "silver_customers": q_silver_customers,
    "silver_watchlist": q_silver_watchlist,
    "high_value_alert": q_high_value_alert,
    "high_value_alert_skew_split": q_high_value_alert_skew_split,
    "heavy_customers": q_heavy_customers,
    "watchlist_match": q_watchlist_match,
    "watchlist_match_bounded": q_watchlist_match_bounded,
    "watchlist_match_ttl": q_watchlist_match_ttl,
    "watchlist_match_salted": q_watchlist_match_salted,
    "watchlist_match_incremental": q_watchlist_match_incremental,
    "watchlist_match_filtered": q_watchlist_match_filtered,
    "fraud_card_alert": q_fraud_card_alert,
    "fraud_card_alert_state": q_fraud_card_alert_state,
    "tumbling_counts": q_tumbling_counts,
    "sliding_counts": q_sliding_counts,
    "late_rows_dropped": q_late_rows_dropped,
    "late_rows_kept": q_late_rows_kept,
    "join_state_rows": q_join_state_rows,
    "watchlist_match_compacted": q_watchlist_match_compacted,
    "render_high_value_notification": q_render_high_value_notification,
    "render_fraud_notification": q_render_fraud_notification,
    "notification_undeliverable": q_notification_undeliverable,
    "notification_outbox": q_notification_outbox,
    "notification_outbox_repeated": q_notification_outbox_repeated,
    "notification_batch_summary": q_notification_batch_summary,
    "notification_outbox_high_value": q_notification_outbox_high_value,
    "notification_table_flow": q_notification_table_flow,
}.items()}
