"""Sending the outbox: distributed, at least once, counted.

``deliver`` takes the outbox rows that are ready and not yet delivered, hands
each partition to the executors (``mapInPandas``), calls ``send(recipient,
subject, body_html)`` once per message there, and appends the outcome to a
delivery log.  A re-run skips alerts that are already in the log as
delivered, so a failed run can simply be repeated; failures are recorded with
their error and retried next time.  ``send`` is the caller's mail client (an
SMTP client is not part of this library); it should raise on failure.

The contract is at least once: a task that is retried after an executor is
lost, or run twice by speculation, sends its messages again, and the log is
written only when the run ends.  A mail client that must not repeat a message
uses the ``alert_id`` in it (or its own claim on it) as the message's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardsentry.operators.notify import READY
from cardsentry.sources.paths import path_exists

DELIVERY_SCHEMA = "alert_id string, recipient string, delivered boolean, error string"


def _sender(send):
    def run(batches):
        import pandas as pd
        for pdf in batches:
            ok, errors = [], []
            for recipient, subject, body in zip(pdf["recipient"], pdf["subject"], pdf["body_html"]):
                try:
                    send(recipient, subject, body)
                    ok.append(True)
                    errors.append(None)
                except Exception as err:  # noqa: BLE001 - recorded, retried next run
                    ok.append(False)
                    errors.append(str(err))
            yield pd.DataFrame({"alert_id": pdf["alert_id"], "recipient": pdf["recipient"],
                                "delivered": ok, "error": errors})
    return run


def delivered_ids(spark: SparkSession, log_path: str) -> DataFrame | None:
    if not path_exists(spark, log_path):
        return None
    return spark.read.parquet(log_path).where(F.col("delivered")).select("alert_id")


def deliver(outbox: DataFrame, send, log_path: str, run_id: str) -> DataFrame:
    """Send what is ready and not yet delivered; returns this run's log rows."""
    spark = outbox.sparkSession
    pending = outbox.where(F.col("status") == READY).dropDuplicates(["alert_id"])
    done = delivered_ids(spark, log_path)
    if done is not None:
        pending = pending.join(done, "alert_id", "left_anti")
    results = (pending.select("alert_id", "recipient", "subject", "body_html")
               .mapInPandas(_sender(send), DELIVERY_SCHEMA)
               .withColumn("run_id", F.lit(run_id)))
    results.write.mode("append").partitionBy("run_id").parquet(log_path)
    return spark.read.parquet(log_path).where(F.col("run_id") == run_id)


def delivery_summary(log: DataFrame) -> DataFrame:
    """Per run: messages attempted, sent, failed."""
    return log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("delivered")).alias("sent"),
        F.count_if(~F.col("delivered")).alias("failed"),
    )
