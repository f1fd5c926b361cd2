"""Watchlist match with keyed state that expires by timers (``transformWithState``).

Pairs are those of the time-bounded join: a transaction made from an entry's
``effective_from`` up to ``max_lag`` after it.  State is kept by card and period
of length ``max_lag``: a transaction belongs to one period, an entry to the two
in which it can match, so every pair is made once and a period's state is
cleared as a whole by one event-time timer, without reading it.

Rows may come up to ``max_lag`` behind the newest of their side (the watermark's
delay); a late watchlist entry still meets the transactions before it.  Rows
without card or event time match nothing and are left out.  ``salt_buckets``
spreads a hot card's transactions; entries, which are few, are kept under
every sub-key.  The state store must be RocksDB (the session's default here).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cardsentry.operators.alerts import TXN_ALERT_COLUMNS, WATCHLIST_ALERT_COLUMNS, select_renamed

# Transactions that are appended to the state in one call.
APPEND_ROWS = 1000
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# A remembered row: its event time in microseconds and its columns as one text.
STATE = StructType([StructField("at", LongType()), StructField("row", StringType())])


def _processor(lag_us: int, append_rows: int = APPEND_ROWS):
    # A local class travels to the executors by value: they need not have this package.
    pair = Row("t", "w")

    class PeriodMatch(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.transactions = handle.getListState("transactions", STATE)
            self.entries = handle.getListState("entries", STATE)

        def handleInputRows(self, key, rows, timerValues):
            entries = [tuple(e) for e in self.entries.get()]
            fresh, fresh_entries = [], []

            def pairs(transactions, known):
                for at, t in transactions:
                    for start, w in known:
                        if start <= at <= start + lag_us:
                            yield pair(t, w)

            for _, _, _, _, at, t, w in rows:
                if w is None:
                    fresh.append((at, t))
                    yield from pairs(fresh[-1:], entries)
                    if len(fresh) == append_rows:
                        self.transactions.appendList(fresh)
                        fresh = []
                else:
                    entry = (at, w)
                    yield from pairs((tuple(x) for x in self.transactions.get()), [entry])
                    yield from pairs(fresh, [entry])
                    entries.append(entry)
                    fresh_entries.append(entry)
            if fresh:
                self.transactions.appendList(fresh)
            if fresh_entries:
                self.entries.appendList(fresh_entries)
            self.handle.registerTimer((key[1] + 1) * lag_us // 1000)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.transactions.clear()
            self.entries.clear()
            return iter(())

        def close(self):
            pass

    return PeriodMatch()


def keyed_matches(txns: DataFrame, watchlist: DataFrame, max_lag: timedelta, salt_buckets: int = 1) -> DataFrame:
    """Transactions joined with watchlist entries on the card number, in the layout of ``watchlist_matches``."""
    lag_us = int(max_lag.total_seconds() * 1_000_000)
    t = txns.select(*select_renamed(TXN_ALERT_COLUMNS))
    w = watchlist.select(*select_renamed(WATCHLIST_ALERT_COLUMNS))
    delay = f"{lag_us} microseconds"
    period = lambda micros: ((micros - F.pmod(micros, F.lit(lag_us))) / F.lit(lag_us)).cast("long")

    def packed(df):
        # One JSON text a row: Python passes it on without a look at its fields.
        return F.to_json(F.struct(*[F.unix_micros(f.name).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
                                    for f in df.schema.fields]), JSON_OPTIONS)

    def unpacked(df, name):
        schema = StructType([StructField(f.name, LongType() if f.dataType.typeName() == "timestamp" else f.dataType)
                             for f in df.schema.fields])
        row = F.from_json(name, schema, JSON_OPTIONS)
        return [(F.timestamp_micros(row[f.name]) if f.dataType.typeName() == "timestamp" else row[f.name]).alias(f.name)
                for f in df.schema.fields]

    def side(df, card, time, name, keys):
        rows = df.where(card.isNotNull() & F.col(time).isNotNull()).withColumns({"_card": card, "_event_time": F.col(time)})
        rows = rows.withWatermark("_event_time", delay)
        other = "w" if name == "t" else "t"
        at = F.unix_micros(time)
        return (rows.select("_event_time", "_card", *keys(at), at.alias("_at"), packed(df).alias(name),
                            F.lit(None).cast("string").alias(other))
                .select("_event_time", "_card", "_period", "_salt", "_at", "t", "w"))

    salt = F.pmod(F.xxhash64("transaction_id"), F.lit(salt_buckets)).cast("int")
    left = side(t, F.upper("card_number"), "transaction_timestamp", "t",
                lambda at: (period(at).alias("_period"), salt.alias("_salt")))
    right = side(w, F.col("entity_id"), "effective_from", "w",
                 lambda at: (F.explode(F.array(period(at), period(at + F.lit(lag_us)))).alias("_period"), F.lit(0).alias("_salt")))
    if salt_buckets > 1:
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    pairs = (left.unionByName(right).groupBy("_card", "_period", "_salt")
             .transformWithState(_processor(lag_us), "t string, w string", "Append", "EventTime"))
    return pairs.select(*unpacked(t, "t"), *unpacked(w, "w"))
