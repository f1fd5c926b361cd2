"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` consecutive words (a shorter item
is one window).  A window is a set of short shingles; containing the window
means containing all of them, so the prefix it must share is one shingle, and
the rarest of the whole benchmark is taken.  Fixed-size bit sets of the prefix
shingles and of the windows go to every task: a document position that holds a
prefix shingle is looked at under each offset and length that a window can have
there (positional and length bounds), and what passes is joined exactly with
the windows' fingerprints (window and prefix, 128 bits).  The bit sets do not
grow with the benchmark; more windows only let more candidates through.

Defined cases: null text has no words; an item without words has no window;
rows that repeat an item id are one item and an item without an id is the item
``null``; rows that repeat a document id are judged on their own; an empty
benchmark contaminates nothing; an empty document table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (free_names, byte_view, checkpointed, chunk_rows, constants, lower, mix, sequence_hashes,
                     word_bounds, word_hashes)

WINDOW = 13
#: Words of a prefix shingle (fewer for shorter windows).
SHINGLE = 4
#: A document is contaminated if at least one in so many of its words is hit.
RATIO = 20
#: log2 of the bits of each bit set: 1 MiB as 64-bit words, whatever the benchmark's size.
BITS_LOG2 = 23


def text_words(offsets: np.ndarray, data: np.ndarray):
    """Word fingerprints of all texts and the word index at which each begins."""
    small = lower(data)
    starts, ends, first = word_bounds(offsets, small, "alnum")
    return word_hashes(small, starts, ends), first


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """``(item, window, len, shingle, off)``: every shingle of every window."""
    def run(batches):
        for batch in batches:
            offsets, data = byte_view(batch.column("text"))
            names = batch.column("item").to_pylist()
            words, first = text_words(offsets, data)
            out = []
            for name, a, b in zip(names, first[:-1], first[1:]):
                if b == a:
                    continue
                size = int(min(WINDOW, b - a))
                k = min(SHINGLE, size)
                windows = sequence_hashes(words[a:b], size, 100 + size)
                shingles = sequence_hashes(words[a:b], k, 200 + k)
                for off in range(size - k + 1):
                    out.append(([name] * len(windows), windows, np.full(len(windows), size),
                                shingles[off:off + len(windows)], np.full(len(windows), off)))
            if out:
                names, windows, sizes, shingles, offs = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for n in names for x in n], pa.string()), _long(np.concatenate(windows)),
                     pa.array(np.concatenate(sizes), pa.int32()), _long(np.concatenate(shingles)),
                     pa.array(np.concatenate(offs), pa.int32())],
                    ["item", "window", "len", "shingle", "off"])

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "item string, window long, len int, shingle long, off int")


def prefixes(windows: DataFrame) -> DataFrame:
    """``(window, len, shingle, off)``: the rarest shingle of every distinct window."""
    rarity = windows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    return (windows.select("window", "len", "shingle", "off").distinct().join(rarity, "shingle")
            .groupBy("window", "len").agg(F.min(F.struct("n", "shingle", "off")).alias("p"))
            .select("window", "len", "p.shingle", "p.off"))


def bit_set(hashes: DataFrame, column: str) -> np.ndarray:
    """Fixed-size bit set of a column of hashes: at most 2**(BITS_LOG2 - 6) words reach the driver."""
    n = 1 << BITS_LOG2
    place = F.pmod(F.col(column), F.lit(n))
    rows = (hashes.groupBy(F.shiftright(place, 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(%s, 64) as int))" % column)).alias("bits")).collect())
    out = np.zeros(n >> 6, np.int64)
    for word, bits in rows:
        out[word] = bits
    return out.view(np.uint64)


def _in_set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    word = (h & np.uint64((1 << BITS_LOG2) - 1)) >> np.uint64(6)
    return (bits[word.astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def candidates(docs: DataFrame, prefix: DataFrame) -> DataFrame:
    """``(doc_id, print, n_words, hits)`` per row; a hit is ``(start, len, window, shingle)``.

    ``print`` is the text's xxhash64.
    """
    shapes = [tuple(r) for r in prefix.select("len", "off").distinct().collect()]  # at most WINDOW * WINDOW
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((bit_set(prefix, "shingle"), bit_set(prefix, "window")))

    def find(words, first):
        """Start, length, window and shingle of every candidate, by text."""
        shingle_bits, window_bits = held.value
        last = np.repeat(first[1:], np.diff(first))  # end of the text that holds a word
        begin = np.repeat(first[:-1], np.diff(first))
        found = []
        for k in sorted({min(SHINGLE, size) for size, _ in shapes}):
            shingles = sequence_hashes(words, k, 200 + k)
            at = np.flatnonzero(_in_set(shingle_bits, shingles))
            at = at[at + k <= last[at]]
            for size, off in shapes:
                if min(SHINGLE, size) != k or not len(at):
                    continue
                start = at - off
                fits = (start >= begin[at]) & (start + size <= last[at])
                start, held_at = start[fits], at[fits]
                total = np.zeros(len(start), np.uint64)
                for j, c in enumerate(constants(size, 100 + size)):
                    total += words[start + j] * c
                window = mix(total)
                ok = _in_set(window_bits, window)
                found.append((start[ok], np.full(ok.sum(), size, np.int32), window[ok], shingles[held_at[ok]]))
        if not found:
            return [np.zeros(0, t) for t in (np.int64, np.int32, np.uint64, np.uint64)]
        found = [np.concatenate(c) for c in zip(*found)]
        order = np.argsort(found[0], kind="stable")
        return [c[order] for c in found]

    def run(batches):
        for batch in batches:
            offsets, data = byte_view(batch.column("text"))
            for i, j in chunk_rows(offsets):
                words, first = text_words(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]])
                start, size, window, shingle = find(words, first)
                lists = np.searchsorted(start, first)
                owner = np.searchsorted(first, start, "right") - 1
                local = (start - first[np.maximum(owner, 0)]).astype(np.int32)
                hits = pa.StructArray.from_arrays([pa.array(local), pa.array(size, pa.int32()), _long(window), _long(shingle)],
                                                  ["start", "len", "window", "shingle"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("print").slice(i, j - i),
                     pa.array(np.diff(first).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(lists, pa.int32()), hits)], ["doc_id", "print", "n_words", "hits"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.withColumn("print", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, print long, n_words long, hits array<struct<start:int,len:int,window:bigint,shingle:bigint>>")


def covered(runs: str) -> Column:
    """Words in the union of sorted ``(start, len)`` runs."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc, r):
        end = r["start"] + r["len"]
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], r["start"]))).cast("long").alias("n"))

    return F.aggregate(runs, zero, step, lambda a: a["n"])


def judge(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(row, doc_id, print, n_words, n_hit, n_items, items, contaminated)`` per document row.

    ``items`` is the sorted array of the contained items' ids as text.
    """
    windows = checkpointed(benchmark_windows(items))
    prefix = checkpointed(prefixes(windows))
    found = checkpointed(candidates(docs, prefix).withColumn("row", F.monotonically_increasing_id()))
    real = (found.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
            .join(prefix.drop("off"), ["window", "shingle", "len"])
            .groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("runs"),
                                F.collect_set(F.struct("window", "len")).alias("windows")))
    real = checkpointed(real)
    holders = windows.groupBy("window", "len").agg(F.collect_set("item").alias("items"))
    items_of = (real.select("row", F.explode("windows").alias("w")).select("row", "w.*").join(holders, ["window", "len"])
                .groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    out = (found.drop("hits").join(real.select("row", covered("runs").alias("n_hit")), "row", "left")
           .join(items_of, "row", "left")
           .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
           .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))
    return (out.withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (RATIO * F.col("n_hit") >= F.col("n_words"))))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return judge(docs, items).select("doc_id", "n_words", "n_hit", "n_items",
                                     F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, in their own columns."""
    id_, print_ = free_names(docs.columns, "id", "print")
    bad = judge(docs, items).filter("contaminated").select(F.col("doc_id").alias(id_), F.col("print").alias(print_))
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(bad, (F.col("doc_id").cast("long").eqNullSafe(F.col(id_))) & (own == F.col(print_)), "left_anti")
