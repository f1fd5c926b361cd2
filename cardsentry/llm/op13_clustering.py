"""Centroid clustering with exact integer arithmetic behind an n-simplex filter.

Lloyd's rounds over integer vectors.  Squared distances of every vector to a few
pivots are computed once and kept.  They place the vector as the apex of a simplex
over the pivots: coordinates in the span of the pivots and an altitude above it.  The
centroids get their apexes each round.  Between two apexes the Euclidean distance is a
lower bound of the true distance, and with one altitude turned down an upper bound.
A centroid whose lower bound exceeds the least upper bound cannot be the nearest; only
the others are compared, by exact integer distances.  Bounds are widened by the error
of their own rounding, so the filter never decides a tie.

Vectors travel as packed blocks, written once to the checkpoint folder.  A round sends
one row per centroid and dimension of every task; the driver sees centroids only.

Defined cases: a vector that is null, has another number of components, or holds a null
or non-finite entry takes no part; a row without an id is clustered, and starts a
centroid only where ids do not suffice; rows that repeat an id are separate vectors (the
smaller vector starts first); equal centroids leave all vectors to the smaller number,
and the other, empty, stays; with fewer vectors than centroids every vector starts one;
an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .vectors import SUMS, decimals, integers, largest, matrix, summed, sums_batch

SCALE, SIZE = 1024, 64
CENTROIDS, ROUNDS, PIVOTS = 8, 10, 16
SEED = "3:"
#: Rows of a packed block.
BLOCK_ROWS = 4096
#: A pivot nearer to the span of the others than this share of its distance is left out.
FLAT = 1e-3
#: Keys of a centroid's sums that are no dimension: its vectors, and their squared distances.
COUNT, INERTIA = -1, -2
_EPS = float(np.finfo(float).eps)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to the vector ``y`` (Python integers if 64 bits do not do)."""
    reach = largest(x) + largest(y)
    kind = np.int64 if reach * reach * max(1, x.shape[1]) < 1 << 63 else object
    apart = x.astype(kind) - y.astype(kind)
    return (apart * apart).sum(axis=1)


class Simplex:
    """The base simplex of some pivots; ``apex`` places vectors by their pivot distances."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, basis, rows = [pivots[0]], [], []
        for p in pivots[1:]:
            b = (p.astype(object) - pivots[0].astype(object)).astype(float)
            along, rest = np.zeros(len(basis)), b
            for _ in range(2):  # a second pass removes what rounding left
                more = np.array([q @ rest for q in basis])
                along = along + more
                rest = rest - sum((m * q for m, q in zip(more, basis)), np.zeros_like(b))
            height = float(np.linalg.norm(rest))
            if height > FLAT * float(np.linalg.norm(b)):
                basis.append(rest / height)
                rows.append([*along, height])
                self.pivots.append(p)
        m = len(basis)
        low = np.zeros((m, m))
        for i, row in enumerate(rows):
            low[i, :len(row)] = row
        self.inverse = np.linalg.inv(low) if m else low
        self.reach = np.linalg.norm(low, axis=1)
        self.edges = np.array([int(squared(p[None, :], self.pivots[0])[0]) for p in self.pivots[1:]], object)

    def apex(self, x: np.ndarray) -> np.ndarray:
        """Per row: coordinates over the pivots, least and greatest altitude, error of the coordinates."""
        d = [squared(x, p) for p in self.pivots]
        right = np.empty((len(x), len(self.edges)))
        for i, (other, edge) in enumerate(zip(d[1:], self.edges)):
            right[:, i] = (d[0].astype(object) + int(edge) - other.astype(object) if d[0].dtype == object or
                           other.dtype == object or edge >= 1 << 61 else (d[0] - other) + int(edge)).astype(float) / 2
        y = right @ self.inverse.T
        weight = 64 * (len(self.edges) + 1) * _EPS
        length = np.linalg.norm(y, axis=1)
        error = np.linalg.norm((np.abs(right) + self.reach * length[:, None]) @ np.abs(self.inverse).T, axis=1) * weight
        first = d[0].astype(float)
        height = first - length ** 2
        loose = 2 * length * error + error ** 2 + weight * (first + length ** 2)
        low, high = np.sqrt(np.maximum(height - loose, 0)), np.sqrt(np.maximum(height + loose, 0))
        return np.column_stack((y, low, high, error))


def bounds(a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds ``(row, centroid)`` of the distances between apexes."""
    flat = np.sqrt(((a[:, None, :-3] - c[None, :, :-3]) ** 2).sum(axis=2))
    error = a[:, None, -1] + c[None, :, -1] + 64 * _EPS * flat
    (low_a, high_a), (low_c, high_c) = (m.T for m in (a[:, -3:-1], c[:, -3:-1]))
    gap = np.maximum(np.maximum(low_a[:, None] - high_c, low_c - high_a[:, None]), 0)
    lower = np.sqrt(np.maximum(flat - error, 0) ** 2 + gap ** 2)
    upper = np.sqrt((flat + error) ** 2 + (high_a[:, None] + high_c) ** 2)
    return lower * (1 - 16 * _EPS), upper * (1 + 16 * _EPS)


def nearest(x: np.ndarray, apex: np.ndarray, centroids: list[np.ndarray], tops: np.ndarray):
    """``(label, squared distance, exact comparisons)`` of the rows of ``x``; ties go to the smaller centroid."""
    lower, upper = bounds(apex, tops)
    possible = lower <= upper.min(axis=1)[:, None]
    label, best = np.full(len(x), -1), None
    for c, centre in enumerate(centroids):
        rows = np.flatnonzero(possible[:, c])
        d = squared(x[rows], centre)
        if best is None:
            best = np.zeros(len(x), d.dtype)
        if d.dtype == object and best.dtype != object:
            best = best.astype(object)
        better = (label[rows] < 0) | (d < best[rows])
        label[rows[better]], best[rows[better]] = c, d[better]
    return label, best, int(possible.sum())


def packed(rows: DataFrame, simplex: Simplex) -> DataFrame:
    """Blocks ``(ids, kind, x, apex)`` of the vectors, with their cached apexes."""
    def run(batches):
        for batch in batches:
            ids, m = batch.column("id"), matrix(batch.column("x"))
            for i in range(0, len(m), BLOCK_ROWS):
                x = m[i:i + BLOCK_ROWS]
                top = largest(x)
                kind = next(k for k in ("i2", "i4", "i8") if top < 1 << 8 * int(k[1]) - 1 or k == "i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.slice(i, BLOCK_ROWS).to_pylist()], pa.list_(pa.int64())), pa.array([kind]),
                     pa.array([x.astype(kind).tobytes()], pa.binary()),
                     pa.array([simplex.apex(x).tobytes()], pa.binary())], ["ids", "kind", "x", "apex"])

    return rows.mapInArrow(run, "ids array<bigint>, kind string, x binary, apex binary")


def opened(batches):
    """``(ids, x, apex)`` of every packed block."""
    for batch in batches:
        for n, kind in enumerate(batch.column("kind").to_pylist()):
            ids = batch.column("ids")[n].values
            x = np.frombuffer(batch.column("x")[n].as_buffer(), kind).reshape(len(ids), -1).astype(np.int64)
            yield ids, x, np.frombuffer(batch.column("apex")[n].as_buffer(), float).reshape(len(ids), -1)


def totals(blocks: DataFrame, centroids: list[np.ndarray], simplex: Simplex) -> dict[tuple[int, int], int]:
    """Exact sums by centroid: of every dimension, of vectors and of squared distances."""
    tops = simplex.apex(np.array(centroids))

    def run(batches):
        sums = {}
        for _, x, apex in opened(batches):
            label, d, _ = nearest(x, apex, centroids, tops)
            whole = x if largest(x) < 1 << 48 else x.astype(object)
            for c in np.unique(label).tolist():
                own = label == c
                # a block of distances whose sum might leave 64 bits is added as Python integers
                far = d[own].astype(object) if d.dtype == object or int(d[own].max()) >= 1 << 48 else d[own]
                parts = [*enumerate(whole[own].sum(axis=0)), (COUNT, own.sum()), (INERTIA, far.sum())]
                for j, value in parts:
                    sums[c, j] = sums.get((c, j), 0) + int(value)
        if sums:
            yield sums_batch(sums.items())

    return summed(blocks.mapInArrow(run, SUMS))


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, id_col: str = "vec_id",
            vec_col: str = "embedding", size: int = SIZE, scale: int = SCALE, seed: str = SEED,
            pivots: int = PIVOTS) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per vector.

    Distances and inertias are exact, ``decimal(38, 0)`` (null beyond 38 digits).
    """
    rows = integers(vectors, id_col, vec_col, scale, size)
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    chosen = rows.orderBy(order.asc_nulls_last(), "x").limit(max(centroids, pivots)).collect()
    schema = (f"`{id_col}` long, cluster int, distance decimal(38,0), cluster_inertia decimal(38,0), "
              "inertia decimal(38,0), centroid_sha256 string")
    if not chosen:
        return vectors.sparkSession.createDataFrame([], schema)
    chosen = np.array([r.x for r in chosen], np.int64)
    now, simplex = [c for c in chosen[:centroids]], Simplex(chosen[:max(1, pivots)])
    blocks = checkpointed(packed(rows, simplex))
    for _ in range(rounds):
        sums = totals(blocks, now, simplex)
        then = [np.array([sums[c, j] // sums[c, COUNT] for j in range(size)], np.int64) if (c, COUNT) in sums else old
                for c, old in enumerate(now)]
        if all((a == b).all() for a, b in zip(now, then)):
            break  # every further round would repeat this one
        now = then
    sums = totals(blocks, now, simplex)
    tops = simplex.apex(np.array(now))

    def run(batches):
        for ids, x, apex in opened(batches):
            label, d, _ = nearest(x, apex, now, tops)
            yield pa.RecordBatch.from_arrays([ids, pa.array(label, pa.int32()), decimals(d)], ["id", "cluster", "distance"])

    exact = lambda v: F.lit(Decimal(v) if v < 10 ** 38 else None).cast("decimal(38,0)")
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    inertia = [sums.get((c, INERTIA), 0) for c in range(len(now))]
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in now]
    return blocks.mapInArrow(run, "id long, cluster int, distance decimal(38,0)").select(
        F.col("id").alias(id_col), "cluster", "distance", of([exact(v) for v in inertia]).alias("cluster_inertia"),
        exact(sum(inertia)).alias("inertia"), of([F.lit(n) for n in names]).alias("centroid_sha256"))
