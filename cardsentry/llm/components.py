"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of links ``(a, b)``; the root is the component's least node.

    A round first ties the greater neighbours of every node to its least neighbour
    (large star), then ties all lesser neighbours together (small star); the number
    of rounds grows with the logarithm of the component size.  A hub's links are
    combined by aggregation and joins that can be split, never gathered.  Every
    round is written to the checkpoint folder.
    """
    now = checkpointed(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .distinct())
    while True:
        # a forest of stars: every node but the roots has one link, and no root has one upwards
        ends = now.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            now.select("b", F.lit(0), F.lit(1)))
        unfinished = (ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
                      .filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))))
        if unfinished.isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        mins = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(mins, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = checkpointed(small.union(mins).distinct())
