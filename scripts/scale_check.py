"""Scaling check: the flagship pipeline on a multiple of the sf0.1 events.

    python scripts/scale_check.py [copies] [sf_dir]

Writes ``copies`` shifted copies of ``events`` (ids offset, times moved by 30
days per copy) plus ``customer`` and ``nation`` into a run folder under the
shared root, then runs fraud-card alerts twice -- with the stream-stream join
(state store) and with the table-backed matcher -- and prints, for each, the
seconds, alert count, input rows, and the join state it keeps.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cardsentry.operators.alerts import enrich_matches, fraud_card_alerts  # noqa: E402
from cardsentry.operators.layers import bronze_transactions, silver_transactions  # noqa: E402
from cardsentry.plans import catalog as C  # noqa: E402
from cardsentry.plans.runs import DriverTables, Run  # noqa: E402
from cardsentry.session import build_session  # noqa: E402
from cardsentry.sources import driver_tables as D  # noqa: E402
from cardsentry.streaming.matcher import WatchlistMatcher  # noqa: E402
from cardsentry.streaming.metrics import progress_rows  # noqa: E402
from cardsentry.streaming.sinks import finish, stream_to_path  # noqa: E402


def main():
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16, conf={"spark.driver.memory": "8g"})
    data = Run(spark, "scale_input")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    shifted = None
    for k in range(copies):          # a union of shifted copies, no cross join
        part = events.select((F.col("event_id") + k * 10**9).alias("event_id"),
                             (F.col("ts") + F.expr(f"INTERVAL {30 * k} DAYS")).alias("ts"),
                             "user_id", "event_type", "value", "props")
        shifted = part if shifted is None else shifted.unionByName(part)
    shifted.repartition(16).write.parquet(data.path("events.parquet"))
    for t in ("customer", "nation"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(data.path(f"{t}.parquet"))
    src = DriverTables(spark, data.root)
    schema = src.table("events").schema

    def transactions():
        ev = spark.readStream.schema(schema).parquet(data.path("events.parquet"))
        return silver_transactions(bronze_transactions(D.kafka_records(ev, src.table("nation"))))

    for mode in ("state", "tables"):
        run = Run(spark, f"scale_{mode}")
        dim = C.customers_dim(run, src)
        watchlist = C.silver_wl_stream(run, src)
        t0 = time.time()
        if mode == "state":
            q = finish(stream_to_path(fraud_card_alerts(transactions(), watchlist, dim),
                                      run.path("alerts"), run.checkpoint("alerts")))
            alerts = spark.read.parquet(run.path("alerts")).count()
        else:
            matcher = WatchlistMatcher(run.path("matcher"), card_buckets=64,
                                       transform=lambda pairs: enrich_matches(pairs, dim))
            q = finish(matcher.start(transactions(), watchlist, run.checkpoint("matcher")))
            alerts = matcher.matches(spark).count()
        rows = progress_rows(q)
        print(f"{mode:6s} seconds={time.time() - t0:.1f} alerts={alerts} "
              f"input_rows={sum(r[1] for r in rows)} state_rows={max(r[3] for r in rows)} "
              f"state_bytes={max(r[4] for r in rows)}")
    spark.stop()


if __name__ == "__main__":
    main()
