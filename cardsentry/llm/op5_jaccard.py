"""N-gram Jaccard join in size-banded tiles with bitmap signatures.

A document is the set of its distinct word shingles (64-bit fingerprints).  Equal
sets are one node (named by a 64-bit fingerprint of the set), whatever the number
of copies.  Two sets link when their Jaccard similarity reaches the threshold.

1. A fixed-size count sketch over all sets orders shingles from rare to frequent.
2. Linked sets share a shingle of their prefixes (the rarest quarter) and have
   sizes in the same or neighbouring bands.  Buckets of shingles list the nodes
   that share one, band by band; a long list is cut into tiles by size band, and
   tiles of the same and neighbouring bands meet.  Equal lists are looked at once.
3. In a list the parity bitmaps' differing bits bound the symmetric difference of
   two sets from below, so their overlap from above.  What passes is tied together
   (not pair by pair), so every pair that can link is in one component of ties.
4. The components are cut into tiles likewise, and the exact intersection of the
   sorted arrays decides; nodes already connected in a tile are not compared again.
5. The verified links' components are the classes.

Defined cases: null text and text without words have an empty set and link with
nothing; a text of fewer words than a shingle is one shingle of all its words;
rows that repeat an id are separate documents, their id the name of each; a row
without an id gets the least id of its class, null if there is none; an empty
table gives an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NO_ID, byte_view, checkpointed, chunk_rows, constants, deltas, free_names, id_or_null, lower, mix, pack,
                     partitions, plan_bytes, sequence_hashes, starts_of, undelta, unpack, word_bounds, word_hashes)
from .components import components
from .skew import keyed_join, written

WORDS = 5
#: Similarity as a fraction: links have OVER * intersection >= UNDER * union.
OVER, UNDER = 100, 75
#: log2 of the counters of the frequency sketch (32 MiB in memory at most), and of one piece of it.
SKETCH_LOG2, PIECE_LOG2 = 20, 16
#: Most bits of a bitmap.
MAX_BITS = 8192
#: Bounds of a tile: documents and shingles.
TILE_DOCS, TILE_SHINGLES = 500, 2_000_000
#: Stored input bytes behind one bucket of shingles.
BUCKET_BYTES = 32 << 20
#: Bytes of text after which a task sends what it has gathered.
FLUSH_BYTES = 32 << 20
_NODE = constants(4, 51)


def size_bounds(over: int = OVER, under: int = UNDER) -> np.ndarray:
    """Least sizes of the bands: sets that can link are in the same or neighbouring bands."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * over // under + 1)
    return np.array(out)


BOUNDS = size_bounds()


def band_of(size) -> np.ndarray:
    return np.searchsorted(BOUNDS, size, "right") - 1


def shingle_sets(offsets: np.ndarray, data: np.ndarray, k: int = WORDS):
    """Sorted distinct shingles of all texts, and where each text's begin."""
    small = lower(data)
    starts, ends, first = word_bounds(offsets, small, "spaced")
    words = word_hashes(small, starts, ends)
    count = np.diff(first)
    room = np.maximum(count - k + 1, 0)
    shingles = sequence_hashes(words, k, 300 + k)
    at = np.arange(int(room.sum())) + np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])), room)
    text, value = np.repeat(np.arange(len(count)), room), shingles[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < k))
    for size in range(1, k):
        own = short[count[short] == size]
        if len(own):
            total = np.zeros(len(own), np.uint64)
            for j, c in enumerate(constants(size, 300 + size)):
                total += words[first[own] + j] * c
            text, value = np.concatenate((text, own)), np.concatenate((value, mix(total)))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.searchsorted(text[new], np.arange(len(count) + 1))


def node_names(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of every set (0 for an empty one)."""
    size = np.diff(first)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value * _NODE[0]), dtype=np.uint64)))
    more = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value * _NODE[1]), dtype=np.uint64)))
    name = mix((sums[first[1:]] - sums[first[:-1]]) * _NODE[2] + mix(more[first[1:]] - more[first[:-1]]) * _NODE[3]
               + size.astype(np.uint64))
    return np.where(size > 0, name, 0).astype(np.uint64)


def _chunks(batches):
    """Rows of Arrow batches piece by piece: id columns, shingles and where each text's begin."""
    for batch in batches:
        offsets, data = byte_view(batch.column("text"))
        for i, j in chunk_rows(offsets):
            value, first = shingle_sets(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]])
            ids = [batch.column(c).slice(i, j - i) for c in ("doc_id", "print")]
            yield ids, value, first, int(offsets[j] - offsets[i])


def documents_and_sketch(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, print, n, node, bits)`` of all documents, and pieces of the shingle counts (node null)."""
    names = ["doc_id", "print", "n", "node", "bits", "piece", "counts"]

    def run(batches):
        counts, rows = np.zeros(1 << SKETCH_LOG2, np.int64), 0
        for ids, value, first, _ in _chunks(batches):
            counts += np.bincount((value >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64), minlength=len(counts))
            n = len(first) - 1
            rows += n
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array(np.diff(first)), pa.array(node_names(value, first).view(np.int64)),
                 pa.array(bitmaps(value, first), pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if rows:
            pieces = counts.reshape(-1, 1 << PIECE_LOG2)
            n = len(pieces)
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.binary()), pa.array(range(n), pa.int32()),
                 pa.array([pack(p) for p in pieces], pa.binary())], names)

    return docs.mapInArrow(run, "doc_id long, print long, n long, node long, bits binary, piece int, counts binary")


def sketch_of(rows: DataFrame) -> np.ndarray:
    """Sum of the pieces: 2**SKETCH_LOG2 counters, whatever the corpus."""
    def add(batches):
        total = {}
        for batch in batches:
            for piece, blob in zip(*(batch.column(c).to_pylist() for c in ("piece", "counts"))):
                total[piece] = total.get(piece, 0) + unpack(blob, np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([pack(x) for x in total.values()], pa.binary())],
                                             ["piece", "counts"])

    schema, n = "piece int, counts binary", 1 << SKETCH_LOG2 - PIECE_LOG2
    pieces = (rows.filter(F.col("piece").isNotNull()).select("piece", "counts").mapInArrow(add, schema)
              .repartitionById(n, F.col("piece")).mapInArrow(add, schema).collect())
    out = np.zeros((1 << SKETCH_LOG2 - PIECE_LOG2, 1 << PIECE_LOG2), np.int64)
    for piece, counts in pieces:
        out[piece] = unpack(counts, np.int64)
    out = out.ravel()
    mean = max(1.0, out.mean())
    return np.clip(np.log2(np.maximum(out, 1) / mean), 0, 255).astype(np.uint8)


def prefixes(value, first, rank):
    """Prefix shingles ``(shingle, text)``: the rarest that a linked set must share one of."""
    size = np.diff(first)
    keep = size - -(-UNDER * size // OVER) + 1
    text = np.repeat(np.arange(len(size)), size)
    frequent = rank[(value >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)]
    if frequent.any():
        order = np.lexsort((value, frequent, text))
        value, text = value[order], text[order]
    place = np.arange(len(value)) - first[text]
    use = place < keep[text]
    return value[use], text[use]


def lists_of(shingle, band, node, tile: int):
    """Lists of nodes that share a shingle in the same or neighbouring bands.

    Yields ``(names, left, right)``: lists of up to ``tile`` nodes by name (several
    at a time, ``right`` null), then pairs of tiles of the longer ones.
    """
    order = np.lexsort((node, band, shingle))
    shingle, band, node = shingle[order], band[order], node[order]
    fresh = np.ones(len(node), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])
    shingle, band, node = shingle[fresh], band[fresh], node[fresh]
    new = np.ones(len(node), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (band[1:] > band[:-1] + 1)
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(node)))
    if not len(at):
        return
    name = mix(np.add.reduceat(mix(node), at) * _NODE[2] + size.astype(np.uint64))
    few = np.flatnonzero((size > 1) & (size <= tile))
    few = few[np.sort(np.unique(name[few], return_index=True)[1])] if len(few) else few
    for i in range(0, len(few), 20_000):
        part = few[i:i + 20_000]
        flat = np.arange(int(size[part].sum())) + np.repeat(at[part] - np.concatenate(([0], np.cumsum(size[part])[:-1])), size[part])
        yield name[part], np.split(node[flat], np.cumsum(size[part])[:-1]), None
    for k in np.flatnonzero(size > tile):
        own, bands = node[at[k]:at[k] + size[k]], band[at[k]:at[k] + size[k]]
        cut = starts_of(bands)
        parts = [(int(bands[i]), own[x:min(x + tile, j)]) for i, j in zip(cut, np.append(cut[1:], len(own)))
                 for x in range(i, j, tile)]
        for i, (low, left) in enumerate(parts):
            for high, right in parts[i:]:
                if high > low + 1:
                    break
                both = np.concatenate((left, mix(right)))
                yield mix(mix(both).sum(keepdims=True, dtype=np.uint64) * _NODE[3]), [left], [right if right is not left else None]


def shared_lists(docs: DataFrame, rank: np.ndarray) -> DataFrame:
    """``(name, side, node)``: the nodes to compare with each other; with two sides,
    each with those of the other."""
    spark = docs.sparkSession
    n_buckets = max(spark.sparkContext.defaultParallelism, plan_bytes(docs) // BUCKET_BYTES)
    held = spark.sparkContext.broadcast(rank)  # 2**SKETCH_LOG2 bytes
    tile = TILE_DOCS

    def flush(gathered):
        shingle, band, node = (np.concatenate(c) for c in zip(*gathered))
        bucket = (shingle % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((node, bucket))
        at = starts_of(bucket[order])
        rows = [(int(bucket[order[i]]), pack(shingle[order[i:j]]), pack(band[order[i:j]].astype(np.uint8)),
                 pack(deltas(node[order[i:j]]))) for i, j in zip(at, np.append(at[1:], len(order)))]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                ["bucket", "shingle", "band", "node"])

    def send(batches):
        gathered, size = [], 0
        for _, value, first, n_bytes in _chunks(batches):
            name = node_names(value, first)
            order = np.argsort(name, kind="stable")
            once = np.zeros(len(name), bool)
            once[order[starts_of(name[order])]] = True
            once &= name != 0
            shingle, text = prefixes(value, first, held.value)
            use = once[text]
            shingle, text = shingle[use], text[use]
            gathered.append((shingle, band_of(np.diff(first))[text], name[text]))
            size += n_bytes
            if size >= FLUSH_BYTES:
                yield from flush(gathered)
                gathered, size = [], 0
        if gathered:
            yield from flush(gathered)

    def meet(batches):
        shingle, band, node = [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                shingle.append(unpack(r["shingle"], np.uint64))
                band.append(unpack(r["band"], np.uint8).astype(np.int64))
                node.append(undelta(unpack(r["node"], np.uint64)))
        if not shingle:
            return
        shingle, band, node = (np.concatenate(c) for c in (shingle, band, node))
        order = np.argsort(shingle, kind="stable")
        equal = shingle[order][1:] == shingle[order][:-1]
        shared = np.zeros(len(shingle), bool)
        shared[order[1:][equal]] = shared[order[:-1][equal]] = True
        kind = pa.list_(pa.int64())
        for name, left, right in lists_of(shingle[shared], band[shared], node[shared], tile):
            longs = lambda x: None if x is None else x.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), pa.array([longs(x) for x in left], kind),
                 pa.array([longs(x) for x in right] if right else [None] * len(left), kind)], ["name", "a", "b"])

    lists = (docs.mapInArrow(send, "bucket int, shingle binary, band binary, node binary")
             .repartitionById(n_buckets, F.col("bucket"))
             .mapInArrow(meet, "name long, a array<bigint>, b array<bigint>"))
    lists = lists.groupBy("name").agg(F.first("a").alias("a"), F.first("b").alias("b"))
    sides = F.concat(F.transform("a", lambda x: F.struct(F.lit(False).alias("side"), x.alias("node"))),
                     F.transform(F.coalesce("b", F.array().cast("array<bigint>")),
                                 lambda x: F.struct(F.lit(True).alias("side"), x.alias("node"))))
    return lists.select("name", F.explode(sides).alias("m")).select("name", "m.*")


def runs_of(batches, keys: list[str], columns: list[str]):
    """Rows of sorted batches run by run: ``(key, rows)`` of every run of equal keys."""
    key, rows = None, []
    for batch in batches:
        for k, row in zip(zip(*(batch.column(c).to_pylist() for c in keys)),
                          zip(*(batch.column(c).to_pylist() for c in columns))):
            if k != key:
                if len(rows) > 1:
                    yield key, rows
                key, rows = k, []
            rows.append(row)
    if len(rows) > 1:
        yield key, rows


def pair_batches(pairs, size: int = 20_000):
    """Arrow batches of ``(a, b)`` pairs."""
    out = []
    for more in pairs:
        out += more
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])


def ties(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(a, b)``: ties that connect all nodes of a list whose bitmaps let them link."""
    def compare(batches):
        def tied(rows):
            node, side, n, bits = zip(*rows)
            side = np.array(side) if any(side) else None
            return bitmap_ties(np.array(node), side, np.array(n), bits)

        yield from pair_batches(tied(rows) for _, rows in runs_of(batches, ["name"], ["node", "side", "n", "bits"]))

    seated = lists.join(nodes.select("node", "n", "bits"), "node").repartition("name").sortWithinPartitions("name", "node")
    return seated.select("name", "node", "side", "n", "bits").mapInArrow(compare, "a long, b long").distinct()


def tiles(nodes: DataFrame) -> DataFrame:
    """``(node, comp, ta, tb)``: the pairs of tiles in which a node of ``(node, comp, n)`` is compared."""
    bounds = F.array(*[F.lit(int(b)) for b in BOUNDS])
    band = F.size(F.filter(bounds, lambda b: b <= F.col("n"))) - 1
    nodes = nodes.withColumn("band", band)
    parts = lambda: F.greatest(F.ceil(F.count(F.lit(1)) / TILE_DOCS), F.ceil(F.sum("n") / TILE_SHINGLES))
    whole = nodes.groupBy("comp").agg(parts().alias("all_parts"))
    by_band = nodes.groupBy("comp", "band").agg(parts().alias("parts")).join(whole, "comp")
    one = F.col("all_parts") == 1
    counted = (by_band.select("comp", F.when(one, F.lit(0)).otherwise(F.col("band")).alias("tile_band"),
                              F.when(one, F.lit(1)).otherwise(F.col("parts")).cast("int").alias("parts")).distinct())
    tile = lambda band, part: (band * F.lit(1 << 32) + part).cast("long")
    every = counted.select("comp", "tile_band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")) \
        .select("comp", "tile_band", tile(F.col("tile_band"), F.col("part")).alias("tile"))
    other = every.select(F.col("comp").alias("c2"), F.col("tile_band").alias("band2"), F.col("tile").alias("tile2"))
    meetings = every.join(other, (F.col("comp") == F.col("c2")) & (F.col("tile") <= F.col("tile2"))
                          & (F.col("band2") <= F.col("tile_band") + 1)).select(
        "comp", F.col("tile").alias("ta"), F.col("tile2").alias("tb"))
    seats = meetings.select("comp", "ta", "tb", F.col("ta").alias("tile")).union(
        meetings.filter("ta <> tb").select("comp", "ta", "tb", F.col("tb")))
    placed = (nodes.join(whole, "comp").withColumn("tile_band", F.when(one, F.lit(0)).otherwise(F.col("band")))
              .join(counted, ["comp", "tile_band"])
              .withColumn("tile", tile(F.col("tile_band"), F.pmod(F.xxhash64("node"), F.col("parts")))))
    return placed.select("node", "comp", "tile").join(seats, ["comp", "tile"]).select("node", "comp", "ta", "tb", "tile")


def bitmaps(value: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Parity bitmap of every set: a bit tells whether an odd number of its shingles
    hash to it.  The width, a power of two, follows the set's size."""
    size = np.diff(first)
    width = np.full(len(size), 64)
    while (wider := (width < np.minimum(size, MAX_BITS))).any():
        width = np.where(wider, 2 * width, width)
    begin = np.concatenate(([0], np.cumsum(width)))
    text = np.repeat(np.arange(len(size)), size)
    bit = (mix(value) & (width[text] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(begin[text] + bit, minlength=begin[-1]) & 1).astype(np.uint8)
    packed = np.packbits(odd).tobytes()
    return [packed[i // 8:j // 8] for i, j in zip(begin[:-1], begin[1:])]


class Signatures:
    """Bitmaps of several nodes, compared at the narrower one's width.

    The halves of a bitmap added modulo two are the bitmap of half its width.  Sets
    that can link differ in width by a factor of two at most.
    """

    def __init__(self, bits):
        self.width = np.array([len(b) for b in bits])
        self.tables = {}
        for w in np.unique(self.width).tolist():
            own = np.flatnonzero((self.width == w) | (self.width == 2 * w))
            table = np.empty((len(own), w), np.uint8)
            for row, i in enumerate(own):
                b = np.frombuffer(bits[i], np.uint8)
                table[row] = b if len(b) == w else b[:w] ^ b[w:]
            place = np.full(len(bits), -1)
            place[own] = np.arange(len(own))
            self.tables[w] = table.view(np.uint64), place

    def apart(self, i: int, j: np.ndarray) -> np.ndarray:
        """Differing bits of ``i`` and every ``j``."""
        width = np.minimum(self.width[i], self.width[j])
        out = np.empty(len(j), np.int64)
        for w in np.unique(width).tolist():
            table, place = self.tables[w]
            here = width == w
            out[here] = np.bitwise_count(table[place[j[here]]] ^ table[place[i]]).sum(axis=1, dtype=np.int64)
        return out


def _partners(i, side, label, size, signatures):
    """Nodes after ``i`` (or of the other side) that are not connected with it and may
    link by size and bitmap, the nearest first."""
    if side is None:
        j = np.arange(i + 1, len(size))
    elif side[i]:
        return np.zeros(0, np.int64)
    else:
        j = np.flatnonzero(side)
    j = j[(label[j] != label[i]) & (UNDER * np.maximum(size[j], size[i]) <= OVER * np.minimum(size[j], size[i]))]
    if not len(j):
        return j
    apart = signatures.apart(i, j)
    # links have a symmetric difference of at most (OVER - UNDER) / (OVER + UNDER) of both sizes
    near = (OVER + UNDER) * apart <= (OVER - UNDER) * (size[j] + size[i])
    return j[near][np.argsort(apart[near], kind="stable")]


def bitmap_ties(name, side, size, bits):
    """Ties that connect the nodes whose bitmaps let them link."""
    label, out, signatures = np.arange(len(name)), [], Signatures(bits)
    for i in range(len(name)):
        j = _partners(i, side, label, size, signatures)
        while len(j):
            out.append((name[i], name[j[0]]))
            label[label == label[j[0]]] = label[i]
            j = j[label[j] != label[i]]
    return out


def tile_links(name, side, value, first):
    """Links of a tile (or, with ``side``, of a pair of tiles) that connect what is linked."""
    size = np.diff(first)
    label, out, signatures = np.arange(len(name)), [], Signatures(bitmaps(value, first))
    for i in range(len(name)):
        j = _partners(i, side, label, size, signatures)
        own = value[first[i]:first[i + 1]]
        while len(j):
            k, j = j[0], j[1:]
            theirs = value[first[k]:first[k + 1]]
            place = np.minimum(np.searchsorted(theirs, own), len(theirs) - 1)
            common = int((theirs[place] == own).sum())
            if OVER * common >= UNDER * (size[i] + size[k] - common):
                out.append((name[i], name[k]))
                label[label == label[k]] = label[i]
                j = j[label[j] != label[i]]
    return out


def verified(docs: DataFrame, nodes: DataFrame, possible: DataFrame) -> DataFrame:
    """``(a, b)``: exact links that connect every class."""
    wanted = checkpointed(possible.join(nodes, "node").select("node", F.col("root").alias("comp"), "n", "first"))
    seats = tiles(wanted.select("node", "comp", "n"))

    def spell(batches):
        for batch in batches:
            offsets, data = byte_view(batch.column("text"))
            wanted_node = batch.column("node")
            for i, j in chunk_rows(offsets):
                value, first = shingle_sets(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]])
                blobs = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                own = pa.array(node_names(value, first).view(np.int64))
                table = pa.RecordBatch.from_arrays([wanted_node.slice(i, j - i), own, pa.array(blobs, pa.binary())],
                                                   ["node", "own", "shingles"])
                yield table.filter(pc.equal(table.column("node"), table.column("own"))).select(["node", "shingles"])

    # one row spells a node, whether or not it has an id: the least by id and text
    spelled = wanted.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.print").alias("print"))
    texts = docs.join(spelled, ["doc_id", "print"]).select("node", "text")
    # rows that repeat an id and text spell the same set; one is enough
    sets = texts.mapInArrow(spell, "node long, shingles binary").groupBy("node").agg(F.min("shingles").alias("shingles"))
    seated = (sets.join(seats, "node").repartition("comp", "ta", "tb").sortWithinPartitions("comp", "ta", "tb", "node"))

    def compare(batches):
        def links(key, rows):
            node, tile, blobs = zip(*rows)
            side = None if key[1] == key[2] else np.array(tile) != key[1]
            sets_ = [np.frombuffer(x, np.uint64) for x in blobs]
            first = np.concatenate(([0], np.cumsum([len(x) for x in sets_])))
            return tile_links(np.array(node), side, np.concatenate(sets_), first)

        yield from pair_batches(links(key, rows) for key, rows in runs_of(
            batches, ["comp", "ta", "tb"], ["node", "tile", "shingles"]))

    return seated.select("comp", "ta", "tb", "node", "tile", "shingles").mapInArrow(compare, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, print, n_shingles, component_id)`` per row; ``print`` is the text's xxhash64."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    both = checkpointed(documents_and_sketch(rows))
    every = both.filter(F.col("piece").isNull())
    documents = every.select("doc_id", "print", "n", "node")
    nodes = documents.filter("n > 0").groupBy("node").agg(
        F.min("n").alias("n"), F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "print")).alias("first"),
        F.count(F.lit(1)).alias("copies"))
    signed = every.filter("n > 0").groupBy("node").agg(F.min("n").alias("n"), F.first("bits").alias("bits"))
    possible = components(ties(shared_lists(rows, sketch_of(both)), signed))
    linked = components(verified(rows, nodes, possible)).join(nodes.select("node", "least"), "node")
    component = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(nodes.select("node", "least", "copies").join(
        linked.select("node", "root").join(component, "root").select("node", "component_id"), "node", "left")
        .select("node", "copies", F.coalesce("component_id", "least").alias("component_id")))
    own = documents.filter("n = 0").select("doc_id", "print", "n", "node", F.col("doc_id").alias("component_id"))
    out = keyed_join(documents.filter("n > 0"), named, "node", "copies").select(
        "doc_id", "print", "n", "node", "component_id").union(own)
    return out.select(id_or_null("doc_id"), "print", F.col("n").alias("n_shingles"), id_or_null("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of every class stays.

    It is the one with the least id (of rows that repeat it, the least text hash).
    A row without words is a class of its own.
    """
    found = classes(docs).withColumn("component_id", F.coalesce("component_id", F.lit(NO_ID)))
    keep = (found.filter("n_shingles > 0").groupBy("component_id").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "print")).alias("k")).select("k.*"))
    id_, print_ = free_names(docs.columns, "id", "print")
    keep = keep.toDF(*(f"{c}_kept" for c in (id_, print_)))
    name = docs.withColumns({id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                             print_: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    empty = ~F.coalesce(F.regexp_like(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    chosen = name.filter(~empty).join(keep, (F.col(id_) == F.col(f"{id_}_kept")) & (F.col(print_) == F.col(f"{print_}_kept")),
                                      "left_semi")
    return chosen.dropDuplicates([id_, print_]).select(*docs.columns).union(docs.filter(empty))
