"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights by dimension (its terms).  The
candidates are dealt to slots and the queries to strips of bounded size; every
strip meets every slot once, in a task of its own.  There a few queries at a time walk
their terms one by one and scatter weighted postings (the slot's weights in a
dimension, by ascending id) into a tile of dense scores that stays in the
processor's cache.  What beats a query's k-th best so far joins its winners, and
the slots' winners are merged.

Defined cases: a vector that is null or holds a null or non-finite component
takes no part, nor does a row without an id; a missing trailing component
counts as zero; the rows of a query's own id are not its candidates; rows that
repeat an id are separate candidates, while of query rows that repeat an id the
smallest vector asks; an empty table gives an empty result.
Scores are 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import starts_of

SCALE = 256
#: Rows and components of one slot of candidates and of one strip of queries, and winners of
#: one strip (they bound a task's memory and its share of the work).
SLOT_ROWS, SLOT_SIZE = 1 << 14, 1 << 20
STRIP_ROWS, STRIP_SIZE, STRIP_WINNERS = 1 << 15, 1 << 21, 1 << 20
#: Queries and least candidates of a tile of scores, and candidates of a slot's first tile
#: (a product of numpy takes four times as long in rows of up to about 2,600 as in longer ones).
TILE_QUERIES, TILE_ROWS, FIRST_ROWS = 32, 4096, 512
#: Scores above the winners so far, a query, from which a tile is cut to its own k best first.
MANY = 64
LOW = np.iinfo(np.int64).min


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, w)``: integer weights of the vectors that take part."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(vec_col, lambda x: F.floor(F.lit(SCALE) * x.cast("double"))).alias("w")))


def _sizes(vectors: DataFrame, vec_col: str) -> tuple[int, int]:
    """Rows and components, counted."""
    rows, size = vectors.agg(F.count(F.lit(1)), F.sum(F.greatest(F.size(vec_col), F.lit(0)))).first()
    return rows, size or 0


def _packed(batches):
    """Rows as blocks by ``part``: ids and a (row, dimension) matrix of the narrowest integers."""
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
        part = batch.column("part").to_numpy(zero_copy_only=False)
        lists = batch.column("w")
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        low, high = flat.min(initial=0), flat.max(initial=0)
        kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
        start = np.cumsum(size) - size
        rows = max(1, SLOT_SIZE // max(1, int(size.max(initial=0))))
        for n in range(0, len(ids), rows):
            order = n + np.argsort(part[n:n + rows], kind="stable")
            held = np.arange(int(size[order].max()))[None, :] < size[order, None]
            m = np.zeros(held.shape, kind)
            m[held] = flat[(start[order, None] + np.arange(held.shape[1])[None, :])[held]]
            at = starts_of(part[order])
            blocks = list(zip(at, np.append(at[1:], len(order))))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(part[order[at]], pa.int32()),
                "ids": pa.array([ids[order[i:j]].tobytes() for i, j in blocks], pa.binary()),
                "m": pa.array([m[i:j].tobytes() for i, j in blocks], pa.binary()),
                "dim": pa.array(np.full(len(at), m.shape[1]), pa.int32()),
                "width": pa.array(np.full(len(at), m.itemsize), pa.int32())})


def _matrix(blocks) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the (dimension, row) matrix of some blocks."""
    ids = [np.frombuffer(b["ids"], np.int64) for b in blocks]
    out = np.zeros((max(b["dim"] for b in blocks), sum(map(len, ids))), f"i{max(b['width'] for b in blocks)}")
    at = 0
    for b, own in zip(blocks, ids):
        out[:b["dim"], at:at + len(own)] = np.frombuffer(b["m"], f"i{b['width']}").reshape(len(own), b["dim"]).T
        at += len(own)
    return np.concatenate(ids), out


def _largest(m: np.ndarray) -> np.ndarray:
    """Greatest absolute value of every dimension."""
    return np.maximum(m.max(axis=1).astype(float), -m.min(axis=1).astype(float))


def score_type(query: np.ndarray, postings: np.ndarray):
    """The fastest type in which every sum of products is exact; 64-bit integers if none surely is."""
    n = min(len(query), len(postings))
    bound = float((_largest(query[:n]) * _largest(postings[:n])).sum())
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 52 else np.int64


def accumulate(query: np.ndarray, holders: list[int], postings: np.ndarray, scores: np.ndarray,
               product: np.ndarray) -> None:
    """Dense scores (query, row): one term's weighted postings after the other.

    ``query`` is (dimension, query, 1); ``holders``: how many of the queries have the term.
    """
    scores[:] = 0
    for weights, n, weighed in zip(query, holders, postings):
        if 2 * n > len(scores):
            np.multiply(weights, weighed, out=product)
            np.add(scores, product, out=scores)
        elif n:
            has = np.flatnonzero(weights)
            scores[has] += weights[has] * weighed


def better(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """``(query, column)`` of the scores above the query's floor: all of them, or at least the tile's k best."""
    above = scores > floor[:, None]
    if scores.shape[1] > k and np.count_nonzero(above) > max(MANY, k) * len(scores):
        scores[own[:, None] == ids[None, :]] = LOW
        above &= scores >= np.partition(scores, -k, axis=1)[:, -k:][:, :1]
    q, column = np.divmod(np.flatnonzero(above), scores.shape[1])
    other = ids[column] != own[q]
    return q[other], column[other]


def merge(score: np.ndarray, winner: np.ndarray, q: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
    """Put rows ``(q, s, ids)`` among the k winners of their queries: greater scores, then smaller ids."""
    k = score.shape[1]
    hit = np.unique(q)
    q = np.concatenate((np.repeat(hit, k), q))
    s = np.concatenate((score[hit].ravel(), s))
    ids = np.concatenate((winner[hit].ravel(), ids))
    order = np.lexsort((ids, ~s, q))
    at = starts_of(q[order])  # every query has k rows at least
    pick = order[at[:, None] + np.arange(k)]
    score[hit], winner[hit] = s[pick], ids[pick]


def _tiles(rows: int):
    """Column ranges: a short first one, then some of at least ``TILE_ROWS`` and less than twice that."""
    first = min(FIRST_ROWS, rows)
    more = max((rows - first) // TILE_ROWS, int(rows > first))
    cuts = [0, *(first + (rows - first) * i // max(more, 1) for i in range(more + 1))]
    return zip(cuts, cuts[1:])


def winners(own: np.ndarray, query: np.ndarray, ids: np.ndarray, postings: np.ndarray, k: int):
    """``(score, id)`` matrices of the k best rows a query; places without a row have the score ``LOW``."""
    order = np.argsort(ids, kind="stable")  # a later column never wins a tie
    kind = score_type(query, postings)
    ids, postings = ids[order], postings[:, order].astype(kind)
    asking = [(i, own[i:i + TILE_QUERIES], np.ascontiguousarray(query[:, i:i + TILE_QUERIES, None], kind))
              for i in range(0, len(own), TILE_QUERIES)]
    asking = [(*x, np.count_nonzero(x[-1], axis=(1, 2)).tolist()) for x in asking]
    score = np.full((len(own), k), LOW)
    winner = np.full((len(own), k), np.iinfo(np.int64).max)
    room = np.empty((2, TILE_QUERIES * max(FIRST_ROWS, 2 * TILE_ROWS)), kind)
    for a, b in _tiles(len(ids)):
        tile, columns = np.ascontiguousarray(postings[:, a:b]), ids[a:b]
        for i, names, asked, holders in asking:
            scores, product = (r[:len(names) * (b - a)].reshape(len(names), b - a) for r in room)
            accumulate(asked, holders, tile, scores, product)
            q, column = better(scores, columns, names, score[i:i + len(names), -1].astype(kind), k)
            if len(q):
                merge(score, winner, q + i, scores[q, column].astype(np.int64), columns[column])
    return score, winner


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id, score)``: the k best rows of ``vectors`` per query row."""
    rows, size = _sizes(vectors, vec_col)
    asking, asked_size = _sizes(queries, vec_col)
    slots = max(1, -(-rows // SLOT_ROWS), -(-size // SLOT_SIZE))
    strips = max(1, -(-asking // STRIP_ROWS), -(-asked_size // STRIP_SIZE), -(-asking * k // STRIP_WINNERS))
    schema = "part int, ids binary, m binary, dim int, width int"

    def dealt(df, key, n, also=F.lit(0)):
        return df.withColumn("part", ((F.pmod(key, F.lit(n)) + also) % n).cast("int")).mapInArrow(_packed, schema)

    def all_of(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # every strip of queries meets every slot of candidates: the stated queries
    # against all rows, block by block; equal rows of many partitions are dealt apart
    cand = dealt(usable(vectors, id_col, vec_col), F.xxhash64("id", "w"), slots, F.spark_partition_id()).select(
        "*", F.lit(False).alias("asks"), all_of(strips).alias("strip")).withColumn("slot", F.col("part"))
    asked = dealt(usable(queries, id_col, vec_col).groupBy("id").agg(F.min("w").alias("w")), F.xxhash64("id"), strips).select(
        "*", F.lit(True).alias("asks"), F.col("part").alias("strip"), all_of(slots).alias("slot"))
    met = (cand.unionByName(asked).withColumn("task", F.col("strip") * slots + F.col("slot"))
           .drop("part", "strip", "slot").repartitionById(strips * slots, "task"))

    def search(batches):
        tasks: dict = {}
        for batch in batches:
            for r in batch.to_pylist():
                tasks.setdefault(r["task"], ([], []))[r["asks"]].append(r)
        for held, asks in tasks.values():
            if not held or not asks:
                continue
            (own, query), (ids, postings) = _matrix(asks), _matrix(held)
            score, winner = winners(own, query, ids, postings, k)
            found = score > LOW
            yield pa.RecordBatch.from_pydict({"query_id": np.repeat(own, found.sum(axis=1)),
                                              "id": winner[found], "score": score[found]})

    found = met.mapInArrow(search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
