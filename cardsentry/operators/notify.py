"""Notification messages, routing and the outbox, all as column expressions.

Messages are rendered on the executors (``concat`` of escaped values into a
fixed HTML layout); nothing is collected to the driver.  The outbox holds one
row per alert with its recipient and a delivery status, so that the actual
mail sender (outside Spark) can work from a table and a retried micro-batch
cannot produce a second message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.functions.text import (html_escape, location, mask_card, money_text, or_default,
                                       risk_color, time_text)

# Subject lines, section titles and the rows shown in each
# message as (label, kind, columns).  Kinds: text, money, money_currency,
# time, card, location.
HIGH_VALUE_SUBJECT = "🚨 High-Value Transaction Alert - $"
HIGH_VALUE_TITLE = "⚠️ High-Value Transaction Alert"
HIGH_VALUE_INTRO = "A transaction has exceeded the customer's limit."
HIGH_VALUE_ROWS = [
    ("Transaction ID", "text", ("transaction_id",)),
    ("Amount", "money", ("transaction_amount",)),
    ("Customer limit", "money", ("transaction_limit",)),
    ("Customer", "text", ("customer_name",)),
    ("Timestamp", "time", ("transaction_timestamp",)),
    ("Location", "location", ("city", "country")),
]
FRAUD_SUBJECT = ("🚨 FRAUD ALERT - ", " Risk - Card ")
FRAUD_TITLE = "🚨 Fraud Watchlist Alert"
FRAUD_SUMMARY_ROWS = [
    ("Risk Level", "text", ("risk_level",)),
    ("Action Required", "text", ("action",)),
    ("Alert ID", "text", ("alert_id",)),
    ("Alert Time", "time", ("alert_timestamp",)),
]
FRAUD_TRANSACTION_ROWS = [
    ("Transaction ID", "text", ("transaction_id",)),
    ("Customer", "text", ("customer_name",)),
    ("Card Number", "card", ("card_number",)),
    ("Amount", "money_currency", ("amount", "currency")),
    ("Merchant", "text", ("merchant_name",)),
    ("Merchant Category", "text", ("merchant_category",)),
    ("Transaction Type", "text", ("transaction_type",)),
    ("Payment Channel", "text", ("payment_channel",)),
    ("Location", "location", ("transaction_city", "transaction_country")),
    ("Timestamp", "time", ("transaction_timestamp",)),
    ("International", "text", ("is_international",)),
    ("Status", "text", ("transaction_status",)),
]
FRAUD_WATCHLIST_ROWS = [
    ("Watchlist ID", "text", ("watchlist_id",)),
    ("Watch Type", "text", ("watch_type",)),
    ("Risk Level", "text", ("risk_level",)),
    ("Reason Code", "text", ("reason_code",)),
    ("Reason", "text", ("reason_description",)),
    ("Reported By", "text", ("reported_by",)),
    ("Reported Source", "text", ("reported_source",)),
    ("Effective From", "time", ("watchlist_effective_from",)),
    ("Watchlist Location", "location", ("watchlist_city", "watchlist_country")),
]
# Layout pieces; ``{color}`` is replaced by the risk colour column.
PAGE_OPEN = '<html><body style="font-family: Arial, sans-serif; padding: 20px;">'
PAGE_CLOSE = "</body></html>"
BOX_OPEN = '<div style="border: 3px solid {color}; border-radius: 8px; padding: 24px;">'
BOX_CLOSE = "</div>"
TABLE_OPEN = '<table style="width: 100%; border-collapse: collapse;">'
TABLE_CLOSE = "</table>"
ROW_OPEN = '<tr><td style="padding: 8px; font-weight: bold;">'
ROW_MIDDLE = '</td><td style="padding: 8px;">'
ROW_CLOSE = "</td></tr>"
FOOTER = '<p style="font-size: 11px; color: #6c757d;">Automated alert from the fraud signal stream. '
HIGH_VALUE_COLOR = "#ffc107"
READY, NO_RECIPIENT = "ready", "no_recipient"


def cell(kind: str, cols: tuple[str, ...]) -> Column:
    """Display text of one value (``N/A`` when missing), HTML-escaped."""
    if kind == "money":
        text = or_default(money_text(cols[0]))
    elif kind == "money_currency":
        text = F.concat(or_default(money_text(cols[0])), F.lit(" "), F.coalesce(F.col(cols[1]), F.lit("")))
    elif kind == "time":
        text = or_default(time_text(cols[0]))
    elif kind == "card":
        text = or_default(mask_card(cols[0]))
    elif kind == "location":
        text = location(cols[0], cols[1])
    else:
        text = or_default(cols[0])
    return html_escape(text)


def html_rows(rows) -> Column:
    parts = []
    for label, kind, cols in rows:
        parts += [F.lit(ROW_OPEN + label + ROW_MIDDLE), cell(kind, cols), F.lit(ROW_CLOSE)]
    return F.concat(F.lit(TABLE_OPEN), *parts, F.lit(TABLE_CLOSE))


def _colored(template: str, color: Column) -> Column:
    head, tail = template.split("{color}")
    return F.concat(F.lit(head), color, F.lit(tail))


def render_high_value(alerts: DataFrame) -> DataFrame:
    """``alert_id, alert_type, recipient, subject, body_html, event_time``."""
    color = F.lit(HIGH_VALUE_COLOR)
    body = F.concat(
        F.lit(PAGE_OPEN), _colored(BOX_OPEN, color),
        F.lit(f"<h2>{HIGH_VALUE_TITLE}</h2><p>{HIGH_VALUE_INTRO}</p>"),
        html_rows(HIGH_VALUE_ROWS),
        F.lit(FOOTER), html_escape(or_default("alert_id")), F.lit("</p>"),
        F.lit(BOX_CLOSE + PAGE_CLOSE),
    )
    return alerts.select(
        "alert_id", "alert_type", F.col("customer_email").alias("recipient"),
        F.concat(F.lit(HIGH_VALUE_SUBJECT), or_default(money_text("transaction_amount"))).alias("subject"),
        body.alias("body_html"),
        F.col("transaction_timestamp").alias("event_time"),
    )


def render_fraud(alerts: DataFrame) -> DataFrame:
    """Same columns as ``render_high_value``; colour follows the risk level."""
    color = risk_color("risk_level")
    subject = F.concat(F.lit(FRAUD_SUBJECT[0]), or_default("risk_level", "UNKNOWN"),
                       F.lit(FRAUD_SUBJECT[1]), or_default(mask_card("card_number")))
    body = F.concat(
        F.lit(PAGE_OPEN), _colored(BOX_OPEN, color),
        _colored('<h2 style="color: {color};">', color), F.lit(FRAUD_TITLE + "</h2>"),
        F.lit("<h3>Alert Summary</h3>"), html_rows(FRAUD_SUMMARY_ROWS),
        F.lit("<h3>Transaction Details</h3>"), html_rows(FRAUD_TRANSACTION_ROWS),
        F.lit("<h3>Fraud Watchlist Match</h3>"), html_rows(FRAUD_WATCHLIST_ROWS),
        F.lit(FOOTER), html_escape(or_default("alert_type")), F.lit("</p>"),
        F.lit(BOX_CLOSE + PAGE_CLOSE),
    )
    return alerts.select(
        "alert_id", "alert_type", F.col("customer_email").alias("recipient"),
        subject.alias("subject"), body.alias("body_html"),
        F.col("transaction_timestamp").alias("event_time"),
    )


def has_recipient() -> Column:
    return F.coalesce(F.col("recipient"), F.lit("")) != F.lit("")


def with_delivery_status(rendered: DataFrame) -> DataFrame:
    return rendered.withColumn("status", F.when(has_recipient(), F.lit(READY)).otherwise(F.lit(NO_RECIPIENT)))


def undeliverable(rendered: DataFrame) -> DataFrame:
    """Messages that cannot be sent (no recipient address)."""
    return rendered.where(~has_recipient())


def one_per_alert(alerts: DataFrame) -> DataFrame:
    """One row per ``alert_id``: the least by all its columns, so that a replay
    keeps the same one."""
    others = [c for c in alerts.columns if c != "alert_id"]
    return (alerts.groupBy("alert_id").agg(F.min(F.struct(*others)).alias("_r"))
            .select(*[F.col(c) if c == "alert_id" else F.col(f"_r.{c}") for c in alerts.columns]))


def outbox_rows(rendered: DataFrame, batch_id: int) -> DataFrame:
    """Outbox rows of a micro-batch's alerts (one per ``alert_id``)."""
    return (with_delivery_status(rendered)
            .select(F.lit(batch_id).cast("long").alias("batch_id"),
                    F.to_date("event_time").alias("alert_date"),
                    "alert_id", "alert_type", "recipient", "status", "subject", "body_html"))


def batch_summary(outbox: DataFrame) -> DataFrame:
    """Per micro-batch: alerts, ready to send, without recipient."""
    return outbox.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(F.col("status") == READY).alias("ready"),
        F.count_if(F.col("status") == NO_RECIPIENT).alias("no_recipient"),
    )
