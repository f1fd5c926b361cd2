"""Joins whose hot keys are split off, and tables written to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_root

#: A key with more than one part in so many of all rows is hot; there are fewer such keys than this.
HOT_PARTS = 1000


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared checkpoint folder; its file sizes then decide over broadcasts."""
    path = f"{checkpoint_root(df.sparkSession)}/table-{uuid.uuid4().hex[:16]}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def keyed_join(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key and, as ``weight``, the key's rows.

    Hot keys (fewer than ``HOT_PARTS``) are broadcast, so their rows stay where they are; the
    others are joined by shuffle, where no key has more than 1 / HOT_PARTS of the rows.
    Both inputs are read more than once: pass written tables.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_PARTS > total
    few = F.broadcast(table.filter(hot).drop(weight))
    return rows.join(few, key).unionByName(
        rows.join(F.broadcast(table.filter(hot).select(key)), key, "left_anti").join(table.filter(~hot).drop(weight), key))
