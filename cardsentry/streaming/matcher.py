"""Watchlist matching with its history in tables instead of join state.

The stream-stream join of the reference (no time bound) must remember every
transaction forever in its state store.  This matcher gives the same pairs --
every transaction with every watchlist entry of its card, in either arrival
order, at any time distance -- while the history lives in two segmented tables
(``streaming.segments``) on the shared file system, laid out by card so that a
lookup reads only the cards it needs.

One streaming query reads both inputs (a union), and every micro-batch ``k``:

1. appends its transactions ``T_k`` to the transaction history, in folders
   ``segment=<k>/card_bucket=<hash of the card>``, and its entries ``W_k``
   to the watchlist history;
2. emits ``T_k JOIN W(batch <= k)`` -- new transactions against all entries,
   which stay cached until the entries change;
3. emits ``W_k JOIN T(batch < k)`` -- new entries against earlier transactions,
   reading only the folders of the card buckets of the (few) new entries (a
   path glob: the rest of the history is neither listed nor read).

A pair is produced in the batch where its later record arrives, so exactly
once.  Every write replaces only the segment of batch ``k`` and lookups
only read batches before it, so a replayed micro-batch rewrites the same rows.
Segments of earlier batches are merged by size before a batch is worked on, so
the number of folders and files of a lookup stays bounded however many
micro-batches there have been.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.operators.alerts import TXN_ALERT_COLUMNS, WATCHLIST_ALERT_COLUMNS, select_renamed
from cardsentry.operators.joins import BROADCAST_LIMIT_BYTES, maybe_broadcast
from cardsentry.streaming.segments import SegmentTable
from cardsentry.streaming.sinks import stream_foreach_batch


#: So many new cards of a micro-batch are named in the scan of the history, where
#: Parquet's statistics and bloom filters skip what has none of them.
PUSHED_CARDS = 1000


class WatchlistMatcher:
    """``transform`` (optional) is applied to each micro-batch's pairs before
    they are written to ``out_path`` (e.g. ``alerts.enrich_matches``);
    ``watch_types`` / ``statuses`` restrict the entries used (default: all);
    ``written(batch_id)`` is called after a batch's pairs are written;
    ``fan_in`` segments of a size are merged into one (``SegmentTable``)."""

    def __init__(self, root: str, card_buckets: int = 64, max_lag: str | None = None,
                 broadcast_limit_bytes: int | None = BROADCAST_LIMIT_BYTES,
                 transform=None, out_path: str | None = None, out_partition_by: list[str] | None = None,
                 watch_types: list[str] | None = None, statuses: list[str] | None = None, written=None, fan_in: int = 8):
        self.root = root
        self.card_buckets = card_buckets
        self.max_lag = max_lag
        self.broadcast_limit_bytes = broadcast_limit_bytes
        self.transform = transform
        self.watch_types, self.statuses = watch_types, statuses
        self.written = written
        self.tx_path = f"{root}/transaction_history"
        self.wl_path = f"{root}/watchlist_history"
        # rows of a bucket lie together in the order of their card, with bloom filters, so
        # that a lookup of a few cards skips most row groups; AQE splits a bucket that
        # holds a hot card over several tasks
        self.tx = SegmentTable(
            self.tx_path, ["card_bucket"], fan_in=fan_in, options={"parquet.bloom.filter.enabled#card_key": "true"},
            arrange=lambda df: df.hint("rebalance", "card_bucket").sortWithinPartitions("card_bucket", "card_key"))
        # the watchlist is always read whole: one folder a segment
        self.wl = SegmentTable(self.wl_path, ["part"], fan_in=fan_in, arrange=lambda df: df.hint("rebalance", "part"))
        self._entries = None         # (segments read, cached entries)
        self.out_path = out_path or f"{root}/matches"
        # output folders: batch_id first (a replay rewrites its own), then these
        self.out_partition_by = ["batch_id"] + list(out_partition_by or [])

    # -- input ------------------------------------------------------------

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.card_buckets)).cast("int")

    def source(self, txns: DataFrame, watchlist: DataFrame) -> DataFrame:
        """Both inputs as one stream: ``side``, ``card_key``, ``card_bucket``,
        and the transaction (``t``) or watchlist (``w``) columns."""
        t = txns.select(*select_renamed(TXN_ALERT_COLUMNS))
        t = t.select(F.lit("T").alias("side"), F.upper("card_number").alias("card_key"),
                     F.struct(*t.columns).alias("t"))
        w = watchlist.select(*select_renamed(WATCHLIST_ALERT_COLUMNS))
        if self.watch_types:
            w = w.where(F.col("watch_type").isin(*self.watch_types))
        if self.statuses:
            w = w.where(F.col("watchlist_status").isin(*self.statuses))
        w = w.select(F.lit("W").alias("side"), F.col("entity_id").alias("card_key"),
                     F.struct(*w.columns).alias("w"))
        both = t.unionByName(w, allowMissingColumns=True)
        return both.withColumn("card_bucket", self._bucket(F.col("card_key")))

    # -- one micro-batch ----------------------------------------------------

    @staticmethod
    def _write(df: DataFrame, path: str, partition_by: list[str]) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))

    def _known_entries(self, spark, batch_id: int) -> DataFrame | None:
        """Every watchlist entry up to the batch, read again only when the segments have changed."""
        segments = self.wl.segments(spark, batch_id + 1)
        if self._entries is None or self._entries[0] != segments:
            self._forget_entries()
            if segments:
                self._entries = (segments, self.wl.read(spark, segments).persist())
        return self._entries[1] if self._entries else None

    def _forget_entries(self) -> None:
        if self._entries is not None:
            self._entries[1].unpersist()
            self._entries = None

    def _time_bound(self, t: DataFrame, w: DataFrame) -> Column:
        if not self.max_lag:
            return F.lit(True)
        ts, eff = t["t.transaction_timestamp"], w["w.effective_from"]
        return (ts >= eff) & (ts <= eff + F.expr(f"INTERVAL {self.max_lag}"))

    @staticmethod
    def _pairs(t: DataFrame, w: DataFrame, cond: Column) -> DataFrame:
        return t.join(w, cond, "inner").select("t.*", "w.*")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Both history writes read the micro-batch: compute it (source read,
        # parsing) once and keep it for them.
        batch = batch.persist()
        try:
            self._process(batch, batch_id)
        finally:
            batch.unpersist()

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        k = F.lit(batch_id).cast("long")
        new = batch.withColumn("batch_id", k)
        tx_new = new.where(F.col("side") == "T").select("card_key", "t", "batch_id", "card_bucket")
        wl_new = new.where(F.col("side") == "W").select("card_key", "w", "batch_id", "card_bucket")
        # 1. history: batches before this one are closed, so they may be merged
        for table in (self.tx, self.wl):
            table.compact(spark, before=batch_id)
        self.tx.append(tx_new, batch_id)
        added = self.wl.append(wl_new.withColumn("part", F.lit(0)), batch_id)
        if added is not None:
            self._forget_entries()
        parts = []
        # 2. new transactions (the persisted micro-batch) against every entry so far
        w_all = self._known_entries(spark, batch_id)
        if w_all is not None:
            w_side = maybe_broadcast(w_all, self.broadcast_limit_bytes)
            parts.append(self._pairs(tx_new, w_side, (tx_new["card_key"] == w_side["card_key"])
                                     & self._time_bound(tx_new, w_side)))
        # 3. new entries against earlier transactions of their card buckets
        if added is not None:
            # read back from their segment: the micro-batch tells the planner only its whole size,
            # and the history would be shuffled to meet entries that are few enough to be broadcast
            entries = self.wl.read(spark, [added])
            buckets = sorted(r[0] for r in entries.select("card_bucket").distinct().collect())  # <= card_buckets
            t_old = self.tx.read(spark, self.tx.segments(spark, batch_id),
                                 "card_bucket={" + ",".join(str(b) for b in buckets) + "}")
            if t_old is not None:
                cards = [r[0] for r in entries.select("card_key").distinct().limit(PUSHED_CARDS + 1).collect()]
                if len(cards) <= PUSHED_CARDS:      # the join below decides either way
                    t_old = t_old.where(F.col("card_key").isin([c for c in cards if c is not None]))
                w_new_side = maybe_broadcast(entries, self.broadcast_limit_bytes)
                parts.append(self._pairs(t_old, w_new_side, (t_old["card_key"] == w_new_side["card_key"])
                                         & self._time_bound(t_old, w_new_side)))
        if not parts:
            return
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if self.transform is not None:
            out = self.transform(out)
        self._write(out.withColumn("batch_id", k), self.out_path, self.out_partition_by)
        if self.written is not None:
            self.written(batch_id)

    # -- wiring ---------------------------------------------------------------

    def start(self, txns: DataFrame, watchlist: DataFrame, checkpoint: str,
              available_now: bool = True, processing_time: str | None = None):
        return stream_foreach_batch(self.source(txns, watchlist), self, checkpoint,
                                    available_now=available_now, processing_time=processing_time)

    def matches(self, spark) -> DataFrame:
        """All pairs found so far (the ``batch_id`` that found them included)."""
        return spark.read.parquet(self.out_path)
