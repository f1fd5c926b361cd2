"""The driver's test tables presented in the payment domain.

``events`` become card transactions delivered as Kafka records, ``customer``
becomes the customer dimension and, for customers with a negative balance,
the fraud watchlist feed (JSON files).  Every column is a rule over the source
row, written once as SQL text so that the Spark side (``selectExpr``) and the
DuckDB oracles read exactly the same input.  The functions take DataFrames, so
they work on static tables and on streams of them.

Placeholders: ``{STR}`` is the string type name of the dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardsentry.schemas import WATCHLIST_FIELDS

# Fixed values of the mapping (transactions from ``events e`` joined with
# ``nation n`` on ``n.n_nationkey = e.event_id % 25``).
TRANSACTION_COLUMNS = [
    ("transaction_id", "concat('TXN', e.event_id)"),
    # some transactions carry no customer, some one the dimension does not know
    ("customer_id", "CASE WHEN e.event_id % 89 = 0 THEN NULL WHEN e.event_id % 5 = 0 "
                    "THEN concat('X', e.user_id) ELSE cast(e.user_id AS {STR}) END"),
    ("card_number", "concat('4000', lpad(cast(e.user_id AS {STR}), 12, '0'))"),
    ("merchant_id", "concat('M', lpad(cast(e.event_id % 50 AS {STR}), 3, '0'))"),
    ("merchant_name", "concat('Merchant ', e.event_id % 50)"),
    ("merchant_category", "upper(e.event_type)"),
    ("amount", "e.value"),
    ("currency", "CASE WHEN e.event_id % 10 = 0 THEN 'EUR' ELSE 'USD' END"),
    ("transaction_type", "CASE e.event_id % 3 WHEN 0 THEN 'ONLINE_PURCHASE' WHEN 1 THEN 'POS_PURCHASE' "
                         "ELSE 'WITHDRAWAL' END"),
    ("payment_channel", "CASE WHEN e.event_type IN ('click', 'view') THEN 'ONLINE' ELSE 'IN_STORE' END"),
    ("device_id", "concat('DEV', e.user_id)"),
    ("city", "concat('City ', e.event_id % 40)"),
    ("country", "n.n_name"),
    ("transaction_timestamp", "e.ts"),
    ("is_international", "e.event_id % 10 = 0"),
    ("status", "CASE WHEN e.event_type = 'error' THEN 'DECLINED' ELSE 'APPROVED' END"),
]
# A payload is cut short (malformed JSON) for these events.
TRUNCATED_EVENT = "e.event_id % 97 = 0"
TRUNCATED_LENGTH = 10
KAFKA_TOPIC = "transactions"
KAFKA_PARTITIONS = 4
JSON_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Customers (``customer c`` joined with ``nation n`` on c_nationkey), all of them.
CUSTOMER_COLUMNS = [
    ("customer_id", "cast(c.c_custkey AS {STR})"),
    ("first_name", "'Customer'"),
    ("last_name", "substring(c.c_name, 10)"),
    ("gender", "CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END"),
    ("age", "cast(18 + c.c_custkey % 60 AS INT)"),
    ("city", "concat('City ', c.c_custkey % 40)"),
    ("state", "concat('State ', c.c_custkey % 10)"),
    ("country", "n.n_name"),
    ("annual_income", "c.c_acctbal * 10"),
    ("customer_segment", "c.c_mktsegment"),
    ("account_open_date", "CASE WHEN c.c_custkey % 53 = 0 THEN 'unknown' ELSE "
                          "concat(2000 + c.c_custkey % 20, '-', lpad(cast(1 + c.c_custkey % 12 AS {STR}), 2, '0'), "
                          "'-', lpad(cast(1 + c.c_custkey % 28 AS {STR}), 2, '0')) END"),
    ("risk_score", "cast(c.c_custkey % 100 AS DOUBLE) / 100"),
    ("preferred_spending_min", "cast(c.c_custkey % 10 AS DOUBLE)"),
    ("preferred_spending_max", "abs(c.c_acctbal) / 20"),
    ("preferred_city", "concat('City ', c.c_custkey % 40)"),
    ("preferred_country", "n.n_name"),
    ("trusted_device_id", "concat('DEV', c.c_custkey)"),
    ("card_number", "concat('4000', lpad(cast(c.c_custkey AS {STR}), 12, '0'))"),
    ("card_type", "CASE c.c_custkey % 3 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' ELSE 'AMEX' END"),
    ("email", "CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE concat('c', c.c_custkey, '@example.com') END"),
    ("transaction_limit", "c.c_acctbal / 50"),
]

# Watchlist: customers with a negative balance.  Entries are effective from
# 2024-01-01 plus c_custkey hours.  Some files carry a field the schema does
# not know, some lines are cut short.
WATCHLIST_MEMBER = "c.c_acctbal < 0"
WATCHLIST_EFFECTIVE = {
    "spark": "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(c.c_custkey AS INT), 0, 0)",
    "duckdb": "TIMESTAMP '2024-01-01 00:00:00' + to_hours(c.c_custkey)",
}
WATCHLIST_TIME_TEXT = {
    "spark": "date_format({t}, 'dd-MMM-yyyy HH:mm:ss')",
    "duckdb": "strftime({t}, '%d-%b-%Y %H:%M:%S')",
}
WATCHLIST_COLUMNS = [
    ("watchlist_id", "concat('WL', lpad(cast(c.c_custkey AS {STR}), 6, '0'))"),
    ("watch_type", "'CARD'"),
    ("entity_id", "concat('4000', lpad(cast(c.c_custkey AS {STR}), 12, '0'))"),
    ("risk_level", "CASE c.c_custkey % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' "
                   "ELSE 'low' END"),
    ("action", "CASE c.c_custkey % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'review' ELSE 'monitor' END"),
    ("reason_code", "concat('RC', lpad(cast(c.c_custkey % 5 AS {STR}), 2, '0'))"),
    ("reason_description", "'Reported for negative account balance'"),
    ("status", "CASE WHEN c.c_custkey % 6 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END"),
    ("effective_from", "{EFF_TEXT}"),
    ("reported_by", "concat('analyst', c.c_custkey % 7)"),
    ("reported_source", "CASE WHEN c.c_custkey % 2 = 0 THEN 'CHARGEBACK' ELSE 'CUSTOMER_REPORT' END"),
    ("country", "n.n_name"),
    ("city", "concat('City ', c.c_custkey % 40)"),
]
WATCHLIST_EXTRA_FIELD = ("note", "'manual'", "c.c_custkey % 11 = 0")
WATCHLIST_TRUNCATED = "c.c_custkey % 13 = 0"
WATCHLIST_TRUNCATED_LENGTH = 24
WATCHLIST_DROP = "effective_month"   # the drop of a line: the month of effective_from
WATCHLIST_DROP_TEXT = {
    "spark": "date_format({t}, 'yyyy-MM')",
    "duckdb": "strftime({t}, '%Y-%m')",
}


def render(expr: str, dialect: str) -> str:
    eff = WATCHLIST_EFFECTIVE[dialect]
    return (expr.replace("{EFF_TEXT}", WATCHLIST_TIME_TEXT[dialect].format(t=eff))
            .replace("{EFF}", eff)
            .replace("{STR}", "STRING" if dialect == "spark" else "VARCHAR"))


def _exprs(columns, dialect="spark"):
    return [f"{render(expr, dialect)} AS {name}" for name, expr in columns]


def _with_nation(df: DataFrame, alias: str, nation: DataFrame, key: str) -> DataFrame:
    # nation has 25 rows by definition of the schema: a fixed, small side.
    n = F.broadcast(nation.select("n_nationkey", "n_name")).alias("n")
    return df.alias(alias).join(n, F.expr(f"n.n_nationkey = {key}"), "inner")


def transactions(events: DataFrame, nation: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """Card transactions (payload fields) from ``events``."""
    joined = _with_nation(events, "e", nation, "e.event_id % 25")
    cols = _exprs(TRANSACTION_COLUMNS)
    if keep_event_id:
        cols = ["e.event_id AS event_id"] + cols
    out = joined.selectExpr(*cols)
    return out.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp"))


def kafka_records(events: DataFrame, nation: DataFrame) -> DataFrame:
    """``events`` as the records a Kafka source would deliver for the topic."""
    tx = transactions(events, nation, keep_event_id=True)
    payload = F.to_json(F.struct(*[F.col(n) for n, _ in TRANSACTION_COLUMNS]),
                        {"timestampFormat": JSON_TIME_FORMAT})
    text = F.when(F.expr(TRUNCATED_EVENT.replace("e.", "")),
                  F.substring(payload, 1, TRUNCATED_LENGTH)).otherwise(payload)
    return tx.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(KAFKA_TOPIC).alias("topic"),
        (F.col("event_id") % KAFKA_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("transaction_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def customer_records(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Rows of the customer dimension as ingested from the operational store."""
    joined = _with_nation(customer, "c", nation, "c.c_nationkey")
    return joined.selectExpr(*_exprs(CUSTOMER_COLUMNS))


def watchlist_lines(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Watchlist feed lines (``value``: one JSON object) with the drop they
    belong to (``effective_month``)."""
    joined = _with_nation(customer, "c", nation, "c.c_nationkey").where(F.expr(WATCHLIST_MEMBER))
    extra_name, extra_value, extra_when = WATCHLIST_EXTRA_FIELD
    fields = _exprs(WATCHLIST_COLUMNS) + [
        f"CASE WHEN {extra_when} THEN {extra_value} END AS {extra_name}",
        f"{WATCHLIST_TRUNCATED} AS cut",
        f"{WATCHLIST_DROP_TEXT['spark'].format(t=render('{EFF}', 'spark'))} AS {WATCHLIST_DROP}",
    ]
    rows = joined.selectExpr(*fields)
    text = F.to_json(F.struct(*[F.col(c) for c in WATCHLIST_FIELDS + [extra_name]]))
    text = F.when(F.col("cut"), F.substring(text, 1, WATCHLIST_TRUNCATED_LENGTH)).otherwise(text)
    return rows.select(text.alias("value"), F.col(WATCHLIST_DROP))


def write_feed(lines: DataFrame, path: str, by: str | None = None) -> None:
    """Append feed lines as text files, few and of AQE's advisory size.

    ``by`` (``effective_month``) puts them into one folder per value, for readers
    that take a value from the folder's name.  The folders then grow with the
    values, and with them what the writing task and every listing of the feed
    have to do.  Rows of a folder are brought together first -- without that every
    task would write a small file into every folder; AQE still splits a folder
    that is much larger than the others."""
    if by is None:
        lines.select("value").hint("rebalance").write.mode("append").text(path)
    else:
        lines.select("value", by).hint("rebalance", by).write.mode("append").partitionBy(by).text(path)


def write_watchlist_feed(customer: DataFrame, nation: DataFrame, path: str, by: str | None = None) -> None:
    """Deliver the watchlist feed as JSON-lines files."""
    write_feed(watchlist_lines(customer, nation), path, by)
