import datetime as dt

from cardsentry.operators.notify import batch_summary, render_fraud
from cardsentry.streaming.outbox import OutboxWriter

ALERT_COLUMNS = ("alert_id string, alert_type string, alert_timestamp timestamp, transaction_id string, "
                 "customer_id string, customer_email string, customer_name string, card_number string, "
                 "amount double, currency string, merchant_id string, merchant_name string, "
                 "merchant_category string, transaction_type string, payment_channel string, device_id string, "
                 "transaction_city string, transaction_country string, transaction_timestamp timestamp, "
                 "is_international boolean, transaction_status string, watchlist_id string, watch_type string, "
                 "risk_level string, action string, reason_code string, reason_description string, "
                 "watchlist_effective_from timestamp, reported_by string, reported_source string, "
                 "watchlist_city string, watchlist_country string")


def alert(aid, email, risk="HIGH"):
    ts = dt.datetime(2024, 3, 1, 10, 0)
    return (aid, "FRAUD_WATCHLIST_MATCH", ts, "T", "C", email, "Ann <Lee>", "4000000000001234", 12.5, "USD",
            "M", "Shop & Co", "RETAIL", "POS", "IN_STORE", "D", "City", "Land", ts, False, "APPROVED",
            "WL1", "CARD", risk, "BLOCK", "R", "reason", ts, "a", "s", "c", "n")


def test_render_fraud(spark):
    df = spark.createDataFrame([alert("A1", "x@example.com"), alert("A2", None, None)], ALERT_COLUMNS)
    got = {r.alert_id: r for r in render_fraud(df).collect()}
    assert got["A1"].subject == "🚨 FRAUD ALERT - HIGH Risk - Card **** 1234"
    assert got["A2"].subject == "🚨 FRAUD ALERT - UNKNOWN Risk - Card **** 1234"
    body = got["A1"].body_html
    assert "#fd7e14" in body and "Shop &amp; Co" in body and "Ann &lt;Lee&gt;" in body
    assert "4000000000001234" not in body          # only the last four digits
    assert "12.50 USD" in body
    assert "#6c757d" in got["A2"].body_html        # unknown risk -> default colour


def test_outbox_one_row_per_alert_and_replay(spark, tmp_dir):
    path = f"{tmp_dir}/outbox"
    sink = OutboxWriter(path, render_fraud)
    batch0 = spark.createDataFrame([alert("A1", "x@example.com"), alert("A1", "x@example.com"),
                                    alert("A2", None)], ALERT_COLUMNS)
    sink(batch0, 0)
    sink(batch0, 0)                                 # replay of the same micro-batch
    sink(spark.createDataFrame([alert("A1", "x@example.com"), alert("A3", "")], ALERT_COLUMNS), 1)
    sink(spark.createDataFrame([], ALERT_COLUMNS), 2)   # empty batch: nothing written
    out = spark.read.parquet(path)
    rows = {r.alert_id: (r.batch_id, r.status) for r in out.collect()}
    assert rows == {"A1": (0, "ready"), "A2": (0, "no_recipient"), "A3": (1, "no_recipient")}
    summary = {r.batch_id: (r.alerts, r.ready, r.no_recipient) for r in batch_summary(out).collect()}
    assert summary == {0: (2, 1, 1), 1: (1, 0, 1)}


def test_outbox_alert_without_event_time(spark, tmp_dir):
    path = f"{tmp_dir}/outbox"
    sink = OutboxWriter(path, render_fraud)
    row = list(alert("N1", "x@example.com"))
    row[18] = None                                   # transaction_timestamp
    sink(spark.createDataFrame([tuple(row)], ALERT_COLUMNS), 0)
    sink(spark.createDataFrame([tuple(row)], ALERT_COLUMNS), 1)    # the same alert again, later batch
    out = spark.read.parquet(path)
    assert [(r.alert_id, r.batch_id, r.alert_date) for r in out.collect()] == [("N1", 0, None)]


def test_delivery_counts_and_rerun(spark, tmp_dir):
    from cardsentry.streaming.delivery import deliver, delivery_summary

    def flaky_send(recipient, subject, body):      # runs on the executors
        if recipient.startswith("bounce"):
            raise RuntimeError("mailbox unavailable")

    path = f"{tmp_dir}/outbox"
    OutboxWriter(path, render_fraud)(spark.createDataFrame(
        [alert("A1", "x@example.com"), alert("A2", "bounce@example.com"), alert("A3", None)], ALERT_COLUMNS), 0)
    outbox = spark.read.parquet(path)
    first = deliver(outbox, flaky_send, f"{tmp_dir}/log", "r1")
    assert {(r.alert_id, r.delivered) for r in first.collect()} == {("A1", True), ("A2", False)}
    second = deliver(outbox, flaky_send, f"{tmp_dir}/log", "r2")     # A1 not sent again, A2 retried
    assert {(r.alert_id, r.delivered) for r in second.collect()} == {("A2", False)}
    summary = {r.run_id: (r.attempted, r.sent, r.failed)
               for r in delivery_summary(spark.read.parquet(f"{tmp_dir}/log")).collect()}
    assert summary == {"r1": (2, 1, 1), "r2": (1, 0, 1)}
