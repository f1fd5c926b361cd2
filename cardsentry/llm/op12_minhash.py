"""MinHash near-dedup by an inverted join over signature coordinates.

A document is the set of its distinct word shingles; equal sets are one node, whatever
the number of copies.  Two sets link when their Jaccard similarity reaches the threshold.

1. A signature holds, for each of ``COORDINATES`` hash functions, the least hash of the
   set.  Linked sets agree in each coordinate with a probability of at least the
   threshold, so fewer than ``MATCHES`` agreements have a probability below 2e-9.
2. Nodes are posted under (coordinate, value) pairs.  With the pairs ordered from rare to
   frequent (a fixed-size count sketch), two nodes of ``MATCHES`` collisions share one of
   their first ``COORDINATES - MATCHES + 1``: only this prefix is posted.
3. The members of a posting list count their collisions.  A node whose coordinates meet
   others in fewer than ``MATCHES`` lists is skipped; the shortest lists of the others are
   merged first, and only nodes met there are counted in the long ones.  Pairs at the
   match threshold are tied.
4. Ties make components; inside them, pairs at the threshold are confirmed by the exact
   intersection of their full sets.  Confirmed links make the classes.

Steps 3 and 4 work in tiles of bounded size and never list the pairs of a group: what is
already connected is not compared again.  A group larger than a tile first joins inside its
tiles; its largest component then meets the nodes outside it, and these meet each other
only if they are still apart.

Defined cases: null text and text without words have an empty set and link with nothing
(their class is their own id); a text of fewer words than a shingle is one shingle of all
its words; rows that repeat an id are separate documents under that name; a row without
an id gets the least id of its class, null if there is none, and is kept only in that case;
an empty table gives an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, byte_view, chunk_rows, constants, id_or_null, mix, pack, partitions, plan_bytes, starts_of, unpack
from .components import components
from .op5_jaccard import node_names, shingle_sets
from .skew import keyed_join, written

WORDS = 2
#: Similarity as a fraction: links have OVER * intersection >= UNDER * union.
OVER, UNDER = 100, 80
COORDINATES, MATCHES = 64, 28
#: log2 of the counters of the frequency sketch, and of one piece of it.
SKETCH_LOG2, PIECE_LOG2 = 20, 16
#: log2 of the nodes from which a posting list is spread over several buckets.
SPLIT_LOG2 = 16
#: Nodes of a tile.
TILE = 256
#: So many tiles of nodes outside a group's largest component meet each other at once.
FEW_TILES = 16
#: Stored input bytes behind one bucket of postings.
BUCKET_BYTES = 32 << 20
#: Nodes after which a task sends the postings it has gathered.
FLUSH_NODES = 20_000
#: Smallest size of a set that may link with another one.
LEAST_SIZE = next(i for i in range(1, 1000) if OVER * i >= UNDER * (i + 1))

_XOR, _TIMES = constants(COORDINATES, 121), constants(COORDINATES, 122)


def signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``(text, coordinate)``: upper half of the least hash of every set (zero for an empty one)."""
    out = np.zeros((len(first) - 1, COORDINATES), np.uint32)
    own = np.flatnonzero(np.diff(first))
    if len(own):
        hashed, starts = np.empty_like(value), first[own]
        for k in range(COORDINATES):
            np.bitwise_xor(value, _XOR[k], out=hashed)
            np.multiply(hashed, _TIMES[k], out=hashed)
            out[own, k] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
    return out


def keys_of(sig: np.ndarray) -> np.ndarray:
    """64-bit names of the (coordinate, value) pairs of signatures."""
    return mix((sig.astype(np.uint64) | (np.arange(1, COORDINATES + 1, dtype=np.uint64) << np.uint64(32))))


def rows_of(column) -> np.ndarray:
    """Signatures of an Arrow binary column."""
    _, data = byte_view(column)
    return np.frombuffer(data.tobytes(), np.uint32).reshape(len(column), COORDINATES)


def signed(rows: DataFrame) -> DataFrame:
    """``(doc_id, print, n, node, sig)`` of rows ``(doc_id, print, text)``; no signature where nothing can link."""
    def run(batches):
        for batch in batches:
            offsets, data = byte_view(batch.column("text"))
            for i, j in chunk_rows(offsets):
                value, first = shingle_sets(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]], WORDS)
                n = np.diff(first)
                sig = [s.tobytes() if size >= LEAST_SIZE else None for s, size in zip(signatures(value, first), n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("print").slice(i, j - i), pa.array(n),
                     pa.array(node_names(value, first).view(np.int64)), pa.array(sig, pa.binary())],
                    ["doc_id", "print", "n", "node", "sig"])

    return rows.mapInArrow(run, "doc_id long, print long, n long, node long, sig binary")


def frequencies(nodes: DataFrame) -> np.ndarray:
    """Rounded-up log2 of the sketch's counters of (coordinate, value) pairs: 2**SKETCH_LOG2 bytes, whatever the corpus."""
    def count(batches):
        total = None
        for batch in batches:
            if len(batch):
                at = (keys_of(rows_of(batch.column("sig"))) >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)
                more = np.bincount(at.ravel(), minlength=1 << SKETCH_LOG2)
                total = more if total is None else total + more
        if total is not None:
            pieces = total.reshape(-1, 1 << PIECE_LOG2)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()),
                                              pa.array([pack(p) for p in pieces], pa.binary())], ["piece", "counts"])

    def add(batches):
        total = {}
        for batch in batches:
            for piece, blob in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist()):
                total[piece] = total.get(piece, 0) + unpack(blob, np.int64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(total, pa.int32()), pa.array([np.ceil(np.log2(np.maximum(c, 1))).astype(np.uint8).tobytes()
                                                        for c in total.values()], pa.binary())], ["piece", "logs"])

    n = 1 << SKETCH_LOG2 - PIECE_LOG2
    out = np.zeros((n, 1 << PIECE_LOG2), np.uint8)
    for piece, logs in (nodes.mapInArrow(count, "piece int, counts binary").repartition(partitions(nodes.sparkSession), "piece")
                        .mapInArrow(add, "piece int, logs binary").collect()):
        out[piece] = np.frombuffer(logs, np.uint8)
    return out.ravel()


def prefix_of(keys: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest ``COORDINATES - MATCHES + 1`` keys of every row, and their sketch logarithms."""
    log = logs[(keys >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)]
    order = (log.astype(np.uint64) << np.uint64(56)) | (keys >> np.uint64(8))
    use = COORDINATES - MATCHES + 1
    at = np.argpartition(order, use - 1, axis=1)[:, :use]
    return np.take_along_axis(keys, at, axis=1), np.take_along_axis(log, at, axis=1)


def postings(nodes: DataFrame, logs: np.ndarray, n_buckets: int) -> DataFrame:
    """``(name, long_key, nodes)``: posting lists of two nodes or more, in pieces of a tile at most.

    A list that has several pieces, or may have, carries its key as ``long_key``.
    """
    held = nodes.sparkSession.sparkContext.broadcast(logs)  # 2**SKETCH_LOG2 bytes
    tile = TILE

    def flush(gathered):
        key, node, n = (np.concatenate(c) for c in zip(*gathered))
        spread = held.value[(key >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)].astype(np.int64) - SPLIT_LOG2
        slots = np.uint64(1) << np.maximum(spread, 0).astype(np.uint64)
        bucket = (mix(key + mix(node) % slots) % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((node, bucket))
        key, node, n, bucket = key[order], node[order], n[order], bucket[order]
        cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        rows = [(int(bucket[i]), pack(key[i:j]), pack(np.diff(node[i:j], prepend=np.uint64(0))), pack(n[i:j].astype(np.uint32)))
                for i, j in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))],
                                         ["bucket", "key", "node", "n"])

    def send(batches):
        gathered, count = [], 0
        for batch in batches:
            if not len(batch):
                continue
            key, _ = prefix_of(keys_of(rows_of(batch.column("sig"))), held.value)
            node = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            n = np.minimum(batch.column("n").to_numpy(zero_copy_only=False), (1 << 32) - 1)
            gathered.append((key.ravel(), np.repeat(node, key.shape[1]), np.repeat(n, key.shape[1])))
            count += len(batch)
            if count >= FLUSH_NODES:
                yield from flush(gathered)
                gathered, count = [], 0
        if gathered:
            yield from flush(gathered)

    def meet(batches):
        key, node, n = [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                key.append(unpack(r["key"], np.uint64))
                node.append(np.cumsum(unpack(r["node"], np.uint64), dtype=np.uint64))
                n.append(unpack(r["n"], np.uint32).astype(np.int64))
        if not key:
            return
        key, node, n = (np.concatenate(c) for c in (key, node, n))
        log = held.value[(key >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)]
        order = np.lexsort((node, n, key))
        key, node, n, split = key[order], node[order], n[order], log[order] > SPLIT_LOG2
        # within a key, a gap in sizes that no link can bridge ends the list
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (OVER * n[:-1] < UNDER * n[1:])
        new[1:] &= (key[1:] != key[:-1]) | ~split[1:]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(key)))
        keep = (size > 1) | split[at]
        parts = -(-size // tile)
        many = (parts > 1) | split[at]
        begin = np.concatenate([a + tile * np.arange(p) for a, p in zip(at[keep], parts[keep])] or [np.zeros(0, np.int64)])
        end = np.minimum(begin + tile, np.repeat(at[keep] + size[keep], parts[keep]))
        of, is_long = key[begin].view(np.int64), np.repeat(many[keep], parts[keep])
        hashed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(node), dtype=np.uint64)))
        name = mix(hashed[end] - hashed[begin] + (end - begin).astype(np.uint64))
        once = is_long.copy()  # equal short lists are looked at once
        once[np.unique(name, return_index=True)[1]] = True
        for i in range(0, len(begin), 20_000):
            pick = i + np.flatnonzero(once[i:i + 20_000])
            lists = [node[a:b].view(np.int64) for a, b in zip(begin[pick], end[pick])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[pick].view(np.int64)), pa.array(of[pick], mask=~is_long[pick]),
                 pa.array(lists, pa.list_(pa.int64()))], ["name", "long_key", "nodes"])

    return (nodes.mapInArrow(send, "bucket int, key binary, node binary, n binary")
            .repartitionById(n_buckets, F.col("bucket"))
            .mapInArrow(meet, "name long, long_key long, nodes array<bigint>"))


def meetings_left(sig: np.ndarray) -> np.ndarray:
    """Rows that meet others in at least ``MATCHES`` coordinates (rows below that are taken away until none is)."""
    alive = np.arange(len(sig))
    while len(alive) > 1:
        part = sig[alive]
        order = np.argsort(part, axis=0)
        value = np.take_along_axis(part, order, axis=0)
        same = np.zeros((len(part) + 1, COORDINATES), bool)
        same[1:-1] = value[1:] == value[:-1]
        met = np.zeros(part.shape, bool)
        np.put_along_axis(met, order, same[1:] | same[:-1], axis=0)
        enough = met.sum(axis=1) >= MATCHES
        if enough.all():
            return alive
        alive = alive[enough]
    return alive[:0]


def collide(node, n, sig, side=None, label=None, sets=None):
    """Edges that connect the pairs of a tile at the match threshold, confirmed by ``sets`` where given.

    With ``side`` only pairs of different sides meet, with ``label`` only those of different labels;
    without labels every component found is tied to its least node, so that tiles with nearly
    the same members give the same edges.
    """
    fresh = label is None
    label = np.arange(len(node)) if fresh else np.unique(label, return_inverse=True)[1]
    alive, out = meetings_left(sig), []
    if not len(alive):
        return out
    node, n, sig, label = node[alive], n[alive], sig[alive], label[alive]
    side = None if side is None else side[alive]
    # lengths of the posting lists of this tile, by row and coordinate
    order = np.argsort(sig, axis=0)
    value = np.take_along_axis(sig, order, axis=0)
    length = np.empty(sig.shape, np.int64)
    for c in range(COORDINATES):
        at = np.append(np.flatnonzero(np.concatenate(([True], value[1:, c] != value[:-1, c]))), len(value))
        length[order[:, c], c] = np.repeat(np.diff(at), np.diff(at))
    length = np.where(length > 1, length, len(sig) + 1)  # a list of one meets nobody
    if sets is not None:
        sets = [sets[k] for k in alive]
        size = np.array([len(x) for x in sets])
        shingles, ids = np.unique(np.concatenate(sets), return_inverse=True)
        ids, held = np.split(ids, np.cumsum(size)[:-1]), np.zeros(len(shingles), bool)

    def linked(i, j):
        """Which of ``j`` share enough shingles with ``i``, by exact counts."""
        held[ids[i]] = True
        common = np.add.reduceat(held[np.concatenate([ids[k] for k in j])], np.cumsum(size[j]) - size[j], dtype=np.int64)
        held[ids[i]] = False
        return OVER * common >= UNDER * (size[i] + size[j] - common)

    for i in range(len(node)):
        j = np.arange(i + 1, len(node)) if side is None else np.flatnonzero(side != side[i])
        j = j[(j > i) & (label[j] != label[i]) & (UNDER * np.maximum(n[j], n[i]) <= OVER * np.minimum(n[j], n[i]))]
        if not len(j):
            continue
        by_length = np.argsort(length[i], kind="stable")
        lists = int((length[i] <= len(sig)).sum())
        short, rest = by_length[:lists - MATCHES + 1], by_length[lists - MATCHES + 1:lists]
        count = (sig[np.ix_(j, short)] == sig[i, short]).sum(axis=1)
        j, count = j[count > 0], count[count > 0]
        for lot in np.array_split(rest, 3):
            count = count + (sig[np.ix_(j, lot)] == sig[i, lot]).sum(axis=1)
            # what cannot reach the threshold any more is skipped
            rest = rest[len(lot):]
            near = count + len(rest) >= MATCHES
            j, count = j[near], count[near]
        if sets is not None and len(j):
            j = j[linked(i, j)]
        while len(j):
            out.append((node[i], node[j[0]]))
            label[label == label[j[0]]] = label[i]
            j = j[label[j] != label[i]]
    if not fresh:
        return out
    order = np.lexsort((node, label))
    at = starts_of(label[order])
    least = np.repeat(node[order][at], np.diff(np.append(at, len(order))))
    return [(a, b) for a, b in zip(least.tolist(), node[order].tolist()) if a != b]


def tiles_of(batches, columns: list[str]):
    """Rows of sorted batches tile by tile: ``((g, ta, tb), rows)``."""
    key, rows = None, []
    for batch in batches:
        for k, row in zip(zip(*(batch.column(c).to_pylist() for c in ("g", "ta", "tb"))),
                          zip(*(batch.column(c).to_pylist() for c in columns))):
            if k != key:
                if rows:
                    yield key, rows
                key, rows = k, []
            rows.append(row)
    if rows:
        yield key, rows


def compared(seats: DataFrame, features: DataFrame, confirm: bool) -> DataFrame:
    """``(g, a, b)``: edges (``g`` null) found in the tiles ``(g, ta, tb, node, tile, label, report)``.

    A tile that reports also gives one node of each of its components as ``(g, a, null)``.
    """
    columns = ["node", "tile", "label", "report", "n", "sig"] + ["shingles"] * confirm

    def edges(key, rows):
        node, tile, label, report, n, sig, *sets = zip(*rows)
        found = []
        if len(node) > 1:
            side = None if key[1] == key[2] else np.array(tile) != key[1]
            found = collide(np.array(node), np.array(n), np.frombuffer(b"".join(sig), np.uint32).reshape(-1, COORDINATES),
                            side, None if label[0] is None else np.array(label),
                            [np.frombuffer(s, np.uint64) for s in sets[0]] if sets else None)
        out = [(None, int(a), int(b)) for a, b in found]
        if report[0]:
            out += [(key[0], x, None) for x in sorted(set(node) - {b for _, _, b in out})]
        return out

    def run(batches):
        out = []
        for key, rows in tiles_of(batches, columns):
            out += edges(key, rows)
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["g", "a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["g", "a", "b"])

    return (seats.join(features, "node").repartition("g", "ta", "tb").sortWithinPartitions("g", "ta", "tb", "node")
            .select("g", "ta", "tb", *columns).mapInArrow(run, "g long, a long, b long").distinct())


def size_band(n):
    """Sizes fall into bands; sets that can link are in the same or neighbouring bands."""
    return F.floor(F.log(n.cast("double")) / float(np.log(OVER / UNDER) * (1 + 1e-6)))


def still_apart(groups: DataFrame, found: DataFrame) -> DataFrame:
    """``(g, node, comp, main, p, q)`` of the groups ``(g, node, n)`` whose nodes are in several components.

    A group is looked at by neighbouring size bands.  ``main`` tells the nodes of its largest
    component, ``p`` and ``q`` the tiles of these and of the other nodes.
    """
    banded = groups.select("node", F.explode(F.array(*[F.xxhash64("g", size_band(F.col("n")) - i) for i in (0, 1)])).alias("g"))
    comp = written(banded.join(found, "node", "left").select("g", "node", F.coalesce("root", "node").alias("comp")))
    counts = comp.groupBy("g", "comp").agg(F.count(F.lit(1)).alias("c"))
    parts = lambda c: F.ceil(c / F.lit(TILE)).cast("int")
    several = (counts.groupBy("g").agg(F.max_by("comp", F.struct("c", "comp")).alias("largest"), F.max("c").alias("c"),
                                       F.sum("c").alias("all")).filter(F.col("c") < F.col("all"))
               .select("g", "largest", parts(F.col("c")).alias("p"), parts(F.col("all") - F.col("c")).alias("q"), "all"))
    out = keyed_join(comp, written(several), "g", "all")
    return written(out.withColumn("main", F.col("comp") == F.col("largest")).drop("largest"))


def seats_of(apart: DataFrame, everyone: bool) -> DataFrame:
    """Tiles in which the largest component of a group meets the others, and these each other.

    The others of a group of many tiles only do so with ``everyone``.
    """
    tile = F.when(F.col("main"), F.pmod(F.xxhash64("node"), F.col("p"))).otherwise(
        F.col("p") + F.pmod(F.xxhash64("node"), F.col("q"))).cast("int")
    last = F.col("p") + F.col("q") - 1
    meets = F.when(F.col("main"), F.sequence(F.col("p"), last)).otherwise(F.sequence(
        F.lit(0), F.when(F.lit(everyone) | (F.col("q") <= FEW_TILES), last).otherwise(F.col("p") - 1)))
    out = apart.withColumn("tile", tile).withColumn("other", F.explode(meets))
    return out.select("g", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"), "node", "tile",
                      F.col("comp").alias("label"), F.lit(False).alias("report"))


def joined(first: DataFrame, members, features: DataFrame, confirm: bool) -> DataFrame:
    """Components of all edges inside groups, from the edges ``first`` found inside their tiles.

    ``members(open)`` gives the groups ``(g, node, n)`` of the tile groups ``open`` (column ``g``)
    whose reported nodes are not all connected.
    """
    first = written(first)
    found = components(first.filter("b IS NOT NULL").select("a", "b"))
    told = first.filter("b IS NULL").select("g", F.col("a").alias("node"))
    if told.isEmpty():
        return found
    groups, root = members(told.join(found, "node", "left").select("g", F.coalesce("root", "node").alias("comp")))
    for everyone in (False, True):
        apart = still_apart(groups, found)
        if apart.isEmpty():
            break
        more = written(compared(seats_of(apart, everyone), features, confirm))
        # what is known already is a star by component
        found = components(written(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more.select("a", "b"))))
        groups = apart.filter(F.col("q") > FEW_TILES).join(root, "node").select("g", "node", "n")
        if everyone or groups.isEmpty():
            break
    return found


def open_groups(comps: DataFrame, group: str = "g") -> DataFrame:
    """The groups with nodes of several components."""
    return (comps.groupBy(group).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select(group))


def possible_classes(nodes: DataFrame, n_buckets: int) -> DataFrame:
    """``(node, root)``: components of the pairs at the match threshold."""
    nodes = nodes.filter(F.col("sig").isNotNull()).select("node", "n", "sig")
    lists = written(postings(nodes, frequencies(nodes), n_buckets))
    seats = (lists.groupBy("name").agg(F.first("nodes").alias("nodes"), F.max(F.col("long_key").isNotNull()).alias("report"))
             .select(F.col("name").alias("g"), F.explode("nodes").alias("node"), "report")
             .select("g", F.lit(0).alias("ta"), F.lit(0).alias("tb"), "node", F.lit(0).alias("tile"),
                     F.lit(None).cast("long").alias("label"), "report"))
    long_lists = lists.filter(F.col("long_key").isNotNull())
    sizes = nodes.select("node", "n")

    def members(comps):
        keys = open_groups(comps.join(long_lists.select(F.col("name").alias("g"), "long_key"), "g"), "long_key")
        rows = long_lists.join(keys, "long_key").select(F.col("long_key").alias("g"), F.explode("nodes").alias("node"))
        return written(rows.distinct().join(sizes, "node")), sizes

    return joined(compared(seats, nodes, False), members, nodes, False)


def confirmed_classes(rows: DataFrame, nodes: DataFrame, possible: DataFrame) -> DataFrame:
    """``(node, root)``: components of the links confirmed on full sets, inside the possible classes."""
    wanted = written(nodes.join(possible, "node").select("node", "n", "sig", "root", "least"))

    def spell(batches):
        for batch in batches:
            offsets, data = byte_view(batch.column("text"))
            for i, j in chunk_rows(offsets):
                value, first = shingle_sets(offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]], WORDS)
                own = pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(i, j - i), pa.array(node_names(value, first).view(np.int64)),
                     pa.array([value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                    ["node", "own", "shingles"])
                yield own.filter(pc.equal(own.column("node"), own.column("own"))).select(["node", "shingles"])

    texts = rows.join(wanted.select(F.col("least.doc_id").alias("doc_id"), F.col("least.print").alias("print"), "node"),
                      ["doc_id", "print"]).select("node", "text")
    # repeated rows spell the same set; one of them is enough
    sets = texts.mapInArrow(spell, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
    features = written(sets.join(wanted.select("node", "n", "sig"), "node"))
    sizes = written(wanted.groupBy("root").agg(F.count(F.lit(1)).alias("c"), F.ceil(F.count(F.lit(1)) / TILE).alias("parts")))
    placed = keyed_join(wanted.select("node", "n", "root"), sizes, "root", "c")
    tile = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    seats = placed.select(F.col("root").alias("g"), tile.alias("ta"), tile.alias("tb"), "node", tile.alias("tile"),
                          F.lit(None).cast("long").alias("label"), (F.col("parts") > 1).alias("report"))

    def members(comps):
        rows = placed.select(F.col("root").alias("g"), "node", "n").join(open_groups(comps), "g")
        return written(rows), wanted.select("node", "n")

    return joined(compared(seats, features, True), members, features, True)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    n_buckets = max(docs.sparkSession.sparkContext.defaultParallelism, plan_bytes(rows) // BUCKET_BYTES)
    documents = written(signed(rows))
    nodes = written(documents.filter("n > 0").groupBy("node").agg(
        F.min("n").alias("n"), F.first("sig").alias("sig"), F.min(F.struct("doc_id", "print")).alias("least"),
        F.count(F.lit(1)).alias("copies")))
    found = confirmed_classes(rows, nodes, possible_classes(nodes, n_buckets))
    linked = written(found.join(nodes.select("node", F.col("least.doc_id").alias("least")), "node"))
    roots = written(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("c")))
    of_node = keyed_join(linked.select("node", "root"), roots, "root", "c").select("node", "component_id")
    named = written(nodes.select("node", F.col("least.doc_id").alias("least"), "copies").join(of_node, "node", "left")
                    .select("node", "copies", F.coalesce("component_id", "least").alias("component_id")))
    slim = documents.select("doc_id", "n", "node")
    every = keyed_join(slim.filter("n > 0"), named, "node", "copies").select("doc_id", "n", "component_id").union(
        slim.filter("n = 0").select("doc_id", "n", "doc_id"))
    kept = (F.col("doc_id") == F.col("component_id")).alias("kept")
    return every.select(id_or_null("doc_id").alias(id_col), F.col("n").alias("n_shingles"), id_or_null("component_id"), kept)
