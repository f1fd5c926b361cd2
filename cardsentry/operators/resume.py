"""Resume a feed from its high-water mark.

The largest numeric id already published (``WL000017`` -> 17) is found with
one aggregation over the published records; only source rows above it are
still to be published.  Unreadable ids in the published records are ignored;
nothing published yet means everything is to be published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardsentry.functions.ids import id_number


def high_water_mark(published: DataFrame, id_col: str = "watchlist_id", prefix: str = "WL"):
    """Scalar column: the largest published id number, 0 when none is readable."""
    return published.select(F.coalesce(F.max(id_number(id_col, prefix)), F.lit(0))).scalar()


def unpublished(source: DataFrame, published: DataFrame, id_col: str = "watchlist_id",
                prefix: str = "WL") -> DataFrame:
    """Rows of ``source`` whose id number is above the high-water mark; every
    row, readable or not, while nothing has been published."""
    nothing = published.select(F.count(F.lit(1)) == 0).scalar()
    above = id_number(id_col, prefix) > high_water_mark(published, id_col, prefix)
    return source.where(nothing | F.coalesce(above, F.lit(False)))
