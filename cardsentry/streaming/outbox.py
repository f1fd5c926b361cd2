"""Idempotent notification outbox fed by ``foreachBatch``.

For each micro-batch: keep one row per ``alert_id`` (always the same one),
leave out alerts already in the outbox from *earlier* batches, render what is
left, and overwrite the outbox partitions of *this* batch (dynamic partition
overwrite).  Replaying a batch after a failure therefore rewrites the same rows
instead of adding a second copy.

Beside the outbox lies an index of the ids alone, a segmented table
(``streaming.segments``) in folders ``segment=.../id_bucket=<hash of alert_id>``,
merged by size.  Every segment keeps Bloom filters of its ids as table rows, cut
into blocks of one size.  A batch's ids are tested against the blocks they fall
into; only folders for which some id passes are read, and there only those ids
are looked for.  An alert is known by its id whatever its day, and no look-up
reads a message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.operators.notify import one_per_alert, outbox_rows
from cardsentry.streaming.segments import Segment, SegmentTable

#: Folders of a segment of the id index (fixed for the life of an outbox).
ID_BUCKETS = 16
#: Bits of a filter block, bits spent on an id, and positions set by an id: a false
#: positive in about 10**5 look-ups, which costs a folder read and nothing else.
BLOCK_BITS, BITS_PER_ID, POSITIONS = 1 << 15, 24, 10
#: So many candidate ids are named in the scan of the index.
PUSHED_IDS = 1000


def id_positions(alert_id: Column) -> Column:
    """The bit positions of an id in its block."""
    h = F.xxhash64(alert_id, F.lit(2))
    step = F.shiftright(h, 20).bitwiseAND(F.lit(BLOCK_BITS - 1)).bitwiseOR(F.lit(1))
    return F.array(*[(h.bitwiseAND(F.lit(BLOCK_BITS - 1)) + step * j).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")
                     for j in range(POSITIONS)])


def id_block(alert_id: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(alert_id, F.lit(1)), blocks).cast("int")


def id_filters(ids: DataFrame, segment: str) -> DataFrame:
    """``(id_bucket, blocks, block, bits)``: Bloom filter blocks of the ids of a segment.

    A block holds about ``BLOCK_BITS / BITS_PER_ID`` ids, so a row has one size whatever
    the segment holds.
    """
    per_block = BLOCK_BITS // BITS_PER_ID
    counts = (ids.groupBy("id_bucket").agg(F.count(F.lit(1)).alias("n"))          # <= id_buckets rows
              .select("id_bucket", F.ceil(F.col("n") / per_block).cast("int").alias("blocks")))
    placed = ids.join(F.broadcast(counts), "id_bucket")
    set_bits = (placed.select("id_bucket", "blocks", id_block(F.col("alert_id"), F.col("blocks")).alias("block"),
                              F.explode(id_positions(F.col("alert_id"))).alias("p"))
                .select("id_bucket", "blocks", "block", F.shiftright("p", 6).alias("word"),
                        F.expr("shiftleft(1L, cast(p & 63 AS INT))").alias("mask")))
    empty = (counts.select("id_bucket", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))).alias("word"), F.lit(0).cast("long").alias("mask")))
    words = (set_bits.unionByName(empty).groupBy("id_bucket", "blocks", "block", "word").agg(F.bit_or("mask").alias("mask")))
    return (words.groupBy("id_bucket", "blocks", "block")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"]).alias("bits"))
            .sortWithinPartitions("id_bucket", "block"))


def may_hold(bits: str = "bits", positions: str = "positions") -> Column:
    """Whether a filter block may hold an id of these positions."""
    return F.expr(f"forall({positions}, p -> (element_at({bits}, cast(shiftright(p, 6) + 1 AS INT)) "
                  "& shiftleft(1L, cast(p & 63 AS INT))) <> 0)")


class OutboxWriter:
    def __init__(self, path: str, render, id_buckets: int = ID_BUCKETS, fan_in: int = 8):
        self.path = path
        self.index_path = f"{path}_ids"
        self.render = render
        self.id_buckets = id_buckets
        self.index = SegmentTable(self.index_path, ["id_bucket"], companion=id_filters, fan_in=fan_in,
                                  arrange=lambda df: df.hint("rebalance", "id_bucket").sortWithinPartitions("id_bucket", "alert_id"))
        self.opened: list[str] = []          # index folders that the newest batch read

    def _candidates(self, alerts: DataFrame, segments: list[Segment]) -> DataFrame:
        """``(segment, id_bucket, alert_id)``: ids that a segment's filters do not rule out."""
        filters = self.index.companions(alerts.sparkSession, segments)
        # one row per segment and bucket tells how many blocks there are
        sizes = filters.where("block = 0").select("segment", "id_bucket", "blocks")
        asked = (alerts.select("id_bucket", "alert_id").join(F.broadcast(sizes), "id_bucket")
                 .withColumn("block", id_block(F.col("alert_id"), F.col("blocks")))
                 .withColumn("positions", id_positions(F.col("alert_id"))))
        return (asked.join(filters.select("segment", "id_bucket", "block", "bits"), ["segment", "id_bucket", "block"])
                .where(may_hold()).select("segment", "id_bucket", "alert_id"))

    def _known(self, alerts: DataFrame, batch_id: int) -> DataFrame | None:
        """Those ids of the batch that earlier batches hold (and maybe others of the folders read)."""
        spark, self.opened = alerts.sparkSession, []
        segments = self.index.segments(spark, batch_id)
        if not segments:
            return None
        found = self._candidates(alerts, segments).persist()
        try:
            folders = found.select("segment", "id_bucket").distinct().collect()     # <= segments x id_buckets
            if not folders:
                return None
            self.opened = sorted(f"{self.index_path}/segment={r.segment}/id_bucket={r.id_bucket}" for r in folders)
            old = spark.read.option("basePath", self.index_path).parquet(*self.opened).select("alert_id")
            ids = [r[0] for r in found.select("alert_id").distinct().limit(PUSHED_IDS + 1).collect()]
            if len(ids) <= PUSHED_IDS:       # the join with the batch decides either way
                old = old.where(F.col("alert_id").isin([i for i in ids if i is not None]))
            return old
        finally:
            found.unpersist()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Several actions follow; the micro-batch (joins and all) is computed
        # once.  Messages are rendered afterwards, for new alerts only.
        alerts = one_per_alert(batch).withColumn(
            "id_bucket", F.pmod(F.xxhash64("alert_id"), F.lit(self.id_buckets)).cast("int")).persist()
        try:
            if alerts.isEmpty():
                return
            self.index.compact(batch.sparkSession, before=batch_id)
            known = self._known(alerts, batch_id)
            fresh = alerts if known is None else alerts.join(known, "alert_id", "left_anti")
            self._write(outbox_rows(self.render(fresh), batch_id).hint("rebalance", "alert_date"),
                        self.path, "alert_date")
            self.index.append(fresh.select("alert_id", F.lit(batch_id).cast("long").alias("batch_id"), "id_bucket"), batch_id)
        finally:
            alerts.unpersist()

    @staticmethod
    def _write(rows: DataFrame, path: str, first: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(first, "batch_id").parquet(path))
