"""Gold alert datasets.

* ``high_value_alerts``: a transaction above its customer's limit
  (stream-static join with the customer dimension).
* ``watchlist_matches`` / ``fraud_card_alerts``: a transaction on a card that
  is on the fraud watchlist (stream-stream join, then enrichment with the
  customer's contact data; the alert survives a missing customer).

Columns are pruned to what the alert needs *before* each join: a
stream-stream join keeps every buffered row of both sides in its state, and a
broadcast ships the whole dimension to every executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.functions.ids import alert_id
from cardsentry.functions.text import full_name
from cardsentry.operators.joins import BROADCAST_LIMIT_BYTES, dimension_join, salted_stream_join
from cardsentry.operators.windows import WATERMARK_DELAY

HIGH_VALUE_TYPE = "HIGH_VALUE_TRANSACTION"
WATCHLIST_MATCH_TYPE = "FRAUD_WATCHLIST_MATCH"


def _now(now: Column | None) -> Column:
    return now if now is not None else F.current_timestamp()


def high_value_alerts(txns: DataFrame, customers: DataFrame, now: Column | None = None,
                      broadcast_limit_bytes: int | None = BROADCAST_LIMIT_BYTES,
                      hot_customers: DataFrame | None = None) -> DataFrame:
    """Transactions whose amount exceeds the customer's ``transaction_limit``.

    Written as a left join followed by the limit test, as specified; a
    customer without a row (or without a limit) cannot pass the test, so the
    optimizer turns it into an inner join and pushes ``transaction_limit IS
    NOT NULL`` into the dimension scan.  ``hot_customers``: see
    ``joins.dimension_join``.
    """
    cust = customers.select("customer_id", "transaction_limit", "email", "first_name", "last_name")
    joined = (dimension_join(txns, cust, "customer_id", "left", broadcast_limit_bytes, hot_customers)
              .where(F.col("amount") > F.col("transaction_limit")))
    return joined.select(
        alert_id("ALERT", "transaction_id").alias("alert_id"),
        F.lit(HIGH_VALUE_TYPE).alias("alert_type"),
        "transaction_id", "customer_id",
        F.col("amount").alias("transaction_amount"),
        "transaction_limit",
        F.col("email").alias("customer_email"),
        full_name("first_name", "last_name").alias("customer_name"),
        "currency", "merchant_name", "merchant_category", "transaction_type", "payment_channel",
        "city", "country", "is_international", "transaction_timestamp", "status",
        _now(now).alias("alert_ts"),
    )


# Columns each side contributes to an alert, renamed where both sides carry
# the same name (city, country, status).
TXN_ALERT_COLUMNS = [
    "transaction_id", "customer_id", "card_number", "amount", "currency", "merchant_id",
    "merchant_name", "merchant_category", "transaction_type", "payment_channel", "device_id",
    ("city", "transaction_city"), ("country", "transaction_country"),
    "transaction_timestamp", "is_international", ("status", "transaction_status"),
]
WATCHLIST_ALERT_COLUMNS = [
    "watchlist_id", "watch_type", "entity_id", "risk_level", "action", "reason_code",
    "reason_description", "effective_from", "reported_by", "reported_source",
    ("city", "watchlist_city"), ("country", "watchlist_country"), ("status", "watchlist_status"),
]


def select_renamed(columns) -> list[Column]:
    return [F.col(c[0]).alias(c[1]) if isinstance(c, tuple) else F.col(c) for c in columns]


def watchlist_matches(txns: DataFrame, watchlist: DataFrame, max_lag: str | None = None,
                      watermark: str | None = WATERMARK_DELAY, salt_buckets: int = 1,
                      watch_types: list[str] | None = None, statuses: list[str] | None = None,
                      watchlist_event_time: str = "effective_from",
                      hot_cards: DataFrame | None = None) -> DataFrame:
    """Transactions joined with watchlist entries on the card number.

    ``max_lag=None`` matches at any time distance and in either arrival order,
    so the join state is never cleaned.  ``max_lag="7 days"`` (say) only
    matches transactions made from ``effective_from`` up to ``max_lag`` after
    it; then the watermarks bound the state of both sides.
    ``watch_types`` / ``statuses`` restrict the entries used (default: all).
    ``salt_buckets`` > 1 spreads a hot card over several state partitions;
    with ``hot_cards`` (one column of upper-cased card numbers, bounded, e.g.
    from ``heavy_hitters``) only those cards are spread; the set may change
    between runs.  Entries are kept under every sub-key.
    ``watchlist_event_time`` can name the ingestion time instead, so that old
    entries arriving late are not dropped by the watermark.
    """
    t = txns.select(*select_renamed(TXN_ALERT_COLUMNS))
    wl_cols = list(WATCHLIST_ALERT_COLUMNS)
    if watchlist_event_time != "effective_from":
        wl_cols.append(watchlist_event_time)
    w = watchlist.select(*select_renamed(wl_cols))
    if watch_types:
        w = w.where(F.col("watch_type").isin(*watch_types))
    if statuses:
        w = w.where(F.col("watchlist_status").isin(*statuses))
    if watermark:
        t = t.withWatermark("transaction_timestamp", watermark)
        w = w.withWatermark(watchlist_event_time, watermark)
    cond = F.upper(t["card_number"]) == w["entity_id"]
    if max_lag:
        cond = (cond & (t["transaction_timestamp"] >= w["effective_from"])
                & (t["transaction_timestamp"] <= w["effective_from"] + F.expr(f"INTERVAL {max_lag}")))
    return salted_stream_join(t, w, cond, "transaction_id", salt_buckets, hot_keys=hot_cards,
                              big_key=F.upper(t["card_number"]))


def enrich_matches(matches: DataFrame, customers: DataFrame, now: Column | None = None,
                   broadcast_limit_bytes: int | None = BROADCAST_LIMIT_BYTES,
                   hot_customers: DataFrame | None = None) -> DataFrame:
    """Watchlist matches with the customer's contact data (left join: the
    alert survives a missing customer), in the alert layout."""
    cust = customers.select("customer_id", "email", "first_name", "last_name")
    joined = dimension_join(matches, cust, "customer_id", "left", broadcast_limit_bytes, hot_customers)
    return joined.select(
        alert_id("FRAUD", "transaction_id", "watchlist_id").alias("alert_id"),
        F.lit(WATCHLIST_MATCH_TYPE).alias("alert_type"),
        _now(now).alias("alert_timestamp"),
        "transaction_id", "customer_id",
        F.col("email").alias("customer_email"),
        full_name("first_name", "last_name").alias("customer_name"),
        "card_number", "amount", "currency", "merchant_id", "merchant_name", "merchant_category",
        "transaction_type", "payment_channel", "device_id", "transaction_city",
        "transaction_country", "transaction_timestamp", "is_international", "transaction_status",
        "watchlist_id", "watch_type", "risk_level", "action", "reason_code", "reason_description",
        F.col("effective_from").alias("watchlist_effective_from"),
        "reported_by", "reported_source", "watchlist_city", "watchlist_country",
    )


def fraud_card_alerts(txns: DataFrame, watchlist: DataFrame, customers: DataFrame,
                      now: Column | None = None,
                      broadcast_limit_bytes: int | None = BROADCAST_LIMIT_BYTES,
                      hot_customers: DataFrame | None = None,
                      **match_options) -> DataFrame:
    """Watchlist matches (stream-stream join) enriched with customer data."""
    matches = watchlist_matches(txns, watchlist, **match_options)
    return enrich_matches(matches, customers, now, broadcast_limit_bytes, hot_customers)
