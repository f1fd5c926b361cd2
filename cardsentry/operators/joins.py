"""Join strategies.

* ``dimension_join``: fact (batch or stream) with a static dimension.  The
  dimension is broadcast only when its estimated size is known and below a
  limit; beyond it the join is left to a shuffle (sort-merge) join, which
  handles any size.
* ``heavy_hitters`` / ``hot_keys=`` of ``dimension_join``: rows of keys that
  carry at least a given share of the fact rows (so there are at most 1/share
  of them) are spread over sub-keys and only those keys' dimension rows are
  copied, in one join over one pass of the fact.  A key holding a third of the
  rows then no longer lands in a single task.
* ``salted_stream_join``: stream-stream equi-join whose key can be very hot
  (one card carrying a third of all transactions).  The large side is spread
  over ``buckets`` sub-keys by a hash of its own row id and the small side is
  copied to every sub-key, so each matching pair is still produced exactly
  once while the state of one key is split over ``buckets`` partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 64 MiB: what we are willing to ship to every executor for one join.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` (from file sizes and statistics);
    ``None`` when it cannot be obtained (e.g. a remote session)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001
        return None


def maybe_broadcast(dim: DataFrame, limit_bytes: int | None = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``broadcast(dim)`` when its estimated size is within ``limit_bytes``,
    else ``dim`` unchanged (the planner then shuffles both sides)."""
    if limit_bytes is None or limit_bytes <= 0:
        return dim
    size = estimated_bytes(dim)
    if size is not None and size <= limit_bytes:
        return F.broadcast(dim)
    return dim


def heavy_hitters(df: DataFrame, key: str, min_share: float = 0.001) -> DataFrame:
    """Keys holding at least ``min_share`` of the rows of ``df`` (batch).

    At most ``1 / min_share`` keys qualify, which bounds what a broadcast of
    the result costs.  Counted with a map-side combined aggregation.  Write
    the result to a table before a stream uses it, so that micro-batches do
    not recount the history.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") >= F.lit(min_share) * total).select(key))


def dimension_join(fact: DataFrame, dim: DataFrame, on: str, how: str = "left",
                   broadcast_limit_bytes: int | None = BROADCAST_LIMIT_BYTES,
                   hot_keys: DataFrame | None = None, hot_buckets: int = 8) -> DataFrame:
    """Join a fact (batch or stream) with a static dimension on key ``on``.

    ``hot_keys`` (one column ``on``, e.g. from ``heavy_hitters`` over recent
    history) names keys to spread: their fact rows go to ``hot_buckets``
    sub-keys by a hash of the row, their dimension rows are copied to each; all
    other rows keep sub-key 0.  The result does not depend on the set, only the
    work's distribution does.  A dimension that is broadcast needs no spreading.
    """
    side = maybe_broadcast(dim, broadcast_limit_bytes)
    if hot_keys is None or side is not dim:
        return fact.join(side, on, how)
    hot = maybe_broadcast(hot_keys.select(F.col(on).alias("_hot_key")).distinct(), broadcast_limit_bytes)
    is_hot = F.col("_hot_key").isNotNull()
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(hot_buckets)).cast("int")
    copies = F.sequence(F.lit(0), F.lit(hot_buckets - 1))
    salted_fact = (fact.join(hot, F.col(on) == F.col("_hot_key"), "left")
                   .withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0))).drop("_hot_key"))
    salted_dim = (dim.join(hot, F.col(on) == F.col("_hot_key"), "left")
                  .withColumn("_salt", F.explode(F.when(is_hot, copies).otherwise(F.array(F.lit(0)))))
                  .drop("_hot_key"))
    return salted_fact.join(salted_dim, [on, "_salt"], how).drop("_salt")


def salted_stream_join(big: DataFrame, small: DataFrame, condition: Column,
                       big_row_id: str, buckets: int = 1, how: str = "inner",
                       hot_keys: DataFrame | None = None, big_key: Column | None = None) -> DataFrame:
    """``big JOIN small ON condition`` with the key split over ``buckets``.

    ``condition`` must contain the equality on the (hot) key; the sub-key is
    added to it.  The sub-key of a ``big`` row is a hash of ``big_row_id``, so
    replays put the row in the same place.  Every ``small`` row is kept under
    all sub-keys, so it meets a ``big`` row wherever that lies: ``hot_keys``
    (one column; ``big_key`` gives the key of ``big``), which spreads only the
    rows of those keys, may differ from one run to the next of a checkpoint.
    ``buckets`` must not (see ``fixed_setting`` in ``plans.graph``).
    """
    if buckets <= 1:
        return big.join(small, condition, how)
    spread = F.pmod(F.xxhash64(F.col(big_row_id)), F.lit(buckets)).cast("int")
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    if hot_keys is None:
        b = big.withColumn("_salt", spread)
    else:
        hot = maybe_broadcast(hot_keys.select(F.col(hot_keys.columns[0]).alias("_hot_key")).distinct()
                              .withColumn("_is_hot", F.lit(True)))
        b = (big.join(hot, big_key == hot["_hot_key"], "left")
             .withColumn("_salt", F.when(F.col("_is_hot"), spread).otherwise(F.lit(0)))
             .drop("_hot_key", "_is_hot"))
    joined = b.join(s, condition & (b["_salt"] == s["_salt"]), how)
    return joined.drop(b["_salt"]).drop(s["_salt"])
