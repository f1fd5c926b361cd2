"""Mixing sources to target weights by capped water-filling (built-in functions only).

``targets`` shares a budget over sources by weight, stops each source at
``max_epochs`` times its own size and gives the excess to the others by
weight until no source is above its stop.  ``mix`` then repeats whole
documents and takes a seeded share of each source for the fractional epoch.

Defined cases: null text has size 0; the null source is a source of its own,
last in order; a source of size 0 gets target 0 and takes nothing; an empty
table gives an empty result; other columns of the input pass through ``mix``
unless they clash with an output column, which then replaces them; rows that
repeat an id are separate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, plan_bytes
from .skew import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Least leading hexadecimal digits of the seeded key that split a source's running sum,
#: and the stored input bytes from which a further digit splits it.
SPLIT_DIGITS, PART_BYTES = 2, 64 << 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``weight`` by the source's place in code-point order, null last, repeating."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(w).cast("double") for w in weights])
    return sources.withColumn("weight", F.get(values, (place % len(weights)).cast("int")))


def targets(sources: DataFrame, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to ``(source, source_size, weight)``: one row per source.

    Sources stop in ascending order of stop/weight.  With the first k stopped,
    the rest share what is left by weight; the water level is the first k at
    which the next source does not stop.
    """
    stop = F.lit(float(max_epochs)) * F.col("source_size")
    order = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) \
        / F.sum("weight").over(after)
    ranked = (sources.withColumn("stop", stop).withColumn("ratio", F.col("stop") / F.col("weight"))
              .withColumns({"level": level, "place": F.row_number().over(order)}))
    water = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything)["level"]
    return (ranked.withColumn("water", water)
            .withColumn("target", F.when(F.col("water").isNull(), F.col("stop"))
                        .otherwise(F.least(F.col("stop"), F.col("water") * F.col("weight"))))
            .drop("stop", "ratio", "level", "place", "water"))


def split_digits(docs: DataFrame) -> int:
    """Leading digits of the seeded key that split a source: more for a larger table, with the same result."""
    digits, size = SPLIT_DIGITS, plan_bytes(docs)
    while size > PART_BYTES * 16 ** digits:
        digits += 1
    return digits


def mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Every document with ``size``, ``source_size``, ``target``, ``taken``.

    A source is read ``floor(target / source_size)`` times in full; the words
    still missing come from its documents in a seeded order, the last of them
    in part.  So a source's taken words are its target rounded down, and no
    document exceeds ``max_epochs`` times its size.  The running sum of a source
    is split by the leading digits of the seeded key, so a hot source is many
    groups.  Texts are shuffled only where the caller keeps them.
    """
    own = ("size", "source_size", "target", "taken")
    extra = [c for c in docs.columns if c.lower() not in own]
    key, part, tie, ahead, g, p, start = free_names(docs.columns, "key", "part", "tie", "ahead", "source", "p", "start")
    sized = docs.select(*extra, n_words(F.col("text")).alias("size"), F.xxhash64("text").alias(tie),
                        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias(key)) \
        .withColumn(part, F.substring(key, 1, split_digits(docs)))
    parts = written(sized.groupBy(F.col("source").alias(g), F.col(part).alias(p)).agg(F.sum("size").alias("part_size")))
    goals = targets(cycled_weights(parts.groupBy(F.col(g).alias("source")).agg(F.sum("part_size").alias("source_size")),
                                   weights), max_epochs).select("source", "source_size", "target")
    before = Window.partitionBy(g).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    starts = written(parts.withColumn(start, F.coalesce(F.sum("part_size").over(before), F.lit(0)))
                     .join(goals, F.col(g).eqNullSafe(F.col("source"))).select(g, p, start, "source_size", "target"))
    running = Window.partitionBy("source", part).orderBy(key, "size", tie).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn(ahead, F.coalesce(F.sum("size").over(running), F.lit(0)))
    goal = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    rest = goal - whole * F.col("source_size") - F.col(start) - F.col(ahead)
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    # the starts are a table of sources times parts; its file size decides whether it is broadcast
    out = placed.join(starts, F.col("source").eqNullSafe(F.col(g)) & (F.col(part) == F.col(p)))
    return out.withColumn("taken", taken.cast("long")).select(*extra, *own)
