"""Bronze and silver datasets: envelope projection, payload parsing, cleansing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.functions.parsing import parse_date, parse_json, parse_timestamp
from cardsentry.operators.quality import apply_expectations, expect, expect_or_drop
from cardsentry.schemas import (CUSTOMER_DATE_FORMAT, CUSTOMER_RECORD, TRANSACTION_PAYLOAD,
                                WATCHLIST_TIME_FORMAT)

# Names and conditions of the expectations (valid_event_time and those of the watchlist are our own),
# and the column names and orders of the datasets below.
TRANSACTION_EXPECTATIONS = [
    expect_or_drop("valid_transaction_id", "transaction_id IS NOT NULL"),
    expect_or_drop("valid_customer_id", "customer_id IS NOT NULL"),
    expect_or_drop("valid_card_number", "card_number IS NOT NULL"),
    expect("valid_amount", "amount > 0"),
    # counted only: the window counts lose such rows without a trace
    expect("valid_event_time", "transaction_timestamp IS NOT NULL"),
]
CUSTOMER_EXPECTATIONS = [
    expect_or_drop("valid_customer_id", "customer_id IS NOT NULL"),
]
# Watchlist rows are all kept; these only count what silver would hide.
WATCHLIST_EXPECTATIONS = [
    expect("no_rescued_data", "_rescued_data IS NULL"),
    expect("valid_effective_from", "effective_from IS NULL OR " +
           f"try_to_timestamp(effective_from, '{WATCHLIST_TIME_FORMAT}') IS NOT NULL"),
]
TRANSACTION_OBSERVATION = "silver_transactions_quality"
CUSTOMER_OBSERVATION = "silver_customers_quality"
WATCHLIST_OBSERVATION = "silver_watchlist_quality"


def _now(now: Column | None) -> Column:
    return now if now is not None else F.current_timestamp()


def bronze_transactions(kafka: DataFrame, now: Column | None = None) -> DataFrame:
    """Kafka records with key and value as text, all envelope fields kept."""
    return kafka.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", "timestampType",
        _now(now).alias("ingesttime"),
    )


def silver_transactions(bronze: DataFrame, now: Column | None = None,
                        expectations=TRANSACTION_EXPECTATIONS,
                        observation=TRANSACTION_OBSERVATION) -> DataFrame:
    """Typed transactions from the JSON payload plus Kafka lineage; rows
    failing a drop expectation are removed, the others are counted."""
    parsed = bronze.select(
        parse_json(F.col("value"), TRANSACTION_PAYLOAD).alias("data"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("ingesttime").alias("bronze_ingestion_ts"),
    ).select(
        "data.*", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
        "bronze_ingestion_ts", _now(now).alias("silver_ingestion_ts"),
    )
    return apply_expectations(parsed, expectations, observation)


def silver_watchlist(bronze: DataFrame, now: Column | None = None,
                     observation=WATCHLIST_OBSERVATION) -> DataFrame:
    """Identifiers, risk and action upper-cased; ``effective_from`` parsed
    (unreadable text -> NULL instead of a failed stream)."""
    if observation is not None:
        bronze = apply_expectations(bronze, WATCHLIST_EXPECTATIONS, observation)
    return bronze.select(
        F.upper("watchlist_id").alias("watchlist_id"),
        "watch_type",
        F.upper("entity_id").alias("entity_id"),
        F.upper("risk_level").alias("risk_level"),
        F.upper("action").alias("action"),
        "reason_code", "reason_description", "status",
        parse_timestamp("effective_from", WATCHLIST_TIME_FORMAT).alias("effective_from"),
        "reported_by", "reported_source", "country", "city", "source_file",
        F.col("ingestion_timestamp").alias("bronze_ingestion_timestamp"),
        _now(now).alias("silver_ingestion_timestamp"),
    )


def silver_customers(bronze: DataFrame, now: Column | None = None,
                     observation=CUSTOMER_OBSERVATION) -> DataFrame:
    """Customer columns kept, opening date parsed, rows without id dropped."""
    cols = []
    for field in CUSTOMER_RECORD.fields:
        if field.name == "account_open_date":
            cols.append(parse_date(field.name, CUSTOMER_DATE_FORMAT).alias(field.name))
        else:
            cols.append(F.col(field.name))
    out = bronze.select(*cols, _now(now).alias("silver_ingestion_timestamp"))
    return apply_expectations(out, CUSTOMER_EXPECTATIONS, observation)


def latest_customers(customers: DataFrame, order_by: str = "silver_ingestion_timestamp") -> DataFrame:
    """One row per ``customer_id``: the greatest by ``order_by`` (batch).

    Name a version or update time of the source where there is one: the
    ingestion clock is one value per micro-batch.  Rows that tie are ordered by
    their other columns, so the choice does not depend on the row order.

    A hash aggregation: combined map-side before the shuffle, so a customer
    with very many versions costs one row per task, not one sort of all.
    """
    others = [c for c in customers.columns if c not in ("customer_id", order_by)]
    picked = F.max(F.struct(order_by, *others)).alias("r")
    return customers.groupBy("customer_id").agg(picked).select(
        *[F.col(c) if c == "customer_id" else F.col(f"r.{c}") for c in customers.columns])
