"""Embedding whitening by a bit-sliced scatter matrix.

1. Vectors become integers; every distinct integer vector is on the fit list once.
2. A task shifts each dimension of a block of rows by its least value and packs the
   bit planes of all dimensions across rows into 64-bit words.  The cross-product of
   two dimensions is the sum over their pairs of planes of 2**(p + q) times the
   popcount of the AND: exact integers, whatever the size of the components.
3. Blocks are brought back to the common origin as integers and added up by Spark in
   base-2**32 digits.  The driver receives one number per pair of dimensions (bounded
   by the dimensions, not by rows), centres them as integers, n * Q - S * S', and
   takes the eigenvectors; an eigenvalue is the exact quotient of its eigenvector.
4. A second pass projects the rows; the covariance of the projected fit list is
   measured by Spark.

Defined cases: a vector that is null or holds a null or non-finite entry is dropped;
a row without an id stays, its id null; repeated rows stay and count once in the fit;
a vector shorter than the longest goes on as if its missing entries were zero (two
vectors of different length are distinct); a component without variance (to double
precision) has no whitened value (null) and no part in ``identity_error``; without any
variance ``explained`` is null too; equal eigenvalues leave their eigenvectors open, as
does every sign; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .vectors import SUMS, decimals, integers, largest, matrix, summed, sums_batch

SCALE = 256
COMPONENTS = 4
#: Rows of a block (a multiple of 64): its planes fill a few MB.
BLOCK_ROWS = 8192
#: Keys of the sums that are no cross-product: sums by dimension, and rows.
TOTAL, ROWS = -1, -2


def bit_planes(u: np.ndarray):
    """Planes of unsigned ``(rows, dims)``: words ``(plane, word)``, and dimension and exponent of each plane."""
    rows, dims = u.shape
    bits = np.array([int(v).bit_length() for v in u.max(axis=0)], np.int64) if rows else np.zeros(dims, np.int64)
    words = -(-rows // 64)
    first = np.concatenate(([0], np.cumsum(bits)))
    out = np.zeros((int(first[-1]), words * 8), np.uint8)
    for p in range(int(bits.max(initial=0))):
        own = np.flatnonzero(bits > p)
        packed = np.packbits(((u[:, own] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), axis=0)
        out[first[own] + p, :len(packed)] = packed.T
    dim = np.repeat(np.arange(dims), bits)
    return out.view(np.uint64), dim, np.arange(len(dim)) - first[dim]


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums ``(dims,)`` and upper-triangular cross-products ``(dims, dims)`` of a block, as Python integers."""
    rows, dims = x.shape
    low = x.min(axis=0)
    words, dim, power = bit_planes(x.astype(np.uint64) - low.astype(np.uint64))
    wide = 2 * int(power.max(initial=0)) + rows.bit_length() > 60
    exact = (lambda c: c.astype(object)) if wide else (lambda c: c)
    q = np.zeros((dims, dims), object)
    total = np.zeros(dims, object)
    for i in range(len(words)):
        common = exact(np.bitwise_count(words[i] & words[i:]).sum(axis=1, dtype=np.int64))
        weighted = common << exact(power[i] + power[i:])
        weighted[1:][dim[i + 1:] == dim[i]] *= 2  # two different planes of one dimension meet twice
        at = np.flatnonzero(np.diff(dim[i:], prepend=-1))
        q[dim[i], dim[i:][at]] += np.add.reduceat(weighted, at).astype(object)
        total[dim[i]] += int(common[0]) << int(power[i])
    low = low.astype(object)
    back = np.outer(total, low) + np.outer(low, total) + rows * np.outer(low, low)
    return total + rows * low, np.triu(q + back)


def scatter_parts(batches):
    """Arrow batches of ``x`` to the task's sums (``vectors.SUMS``)."""
    n, total, q = 0, np.zeros(0, object), np.zeros((0, 0), object)
    for batch in batches:
        m = matrix(batch.column("x"))
        if (d := m.shape[1]) > (old := len(total)):
            wider, q_wider = np.zeros(d, object), np.zeros((d, d), object)
            wider[:old], q_wider[:old, :old] = total, q
            total, q = wider, q_wider
        for i in range(0, len(m), BLOCK_ROWS):
            part, cross = scatter(m[i:i + BLOCK_ROWS])
            d = len(part)
            total[:d] += part
            q[:d, :d] += cross
        n += len(m)
    if n:
        yield sums_batch([((ROWS, 0), n), *(((TOTAL, j), v) for j, v in enumerate(total)),
                          *(((i, j), q[i, j]) for i in range(len(q)) for j in range(i, len(q)))])


class Fit:
    """Mean, components and eigenvalues from exact sums."""

    def __init__(self, sums: dict, components: int):
        self.n = sums.get((ROWS, 0), 0)
        dims = 1 + max((j for i, j in sums if i == TOTAL), default=-1)
        self.total = np.array([sums[TOTAL, j] for j in range(dims)], object)
        centred = np.zeros((dims, dims), object)
        for i in range(dims):
            for j in range(i, dims):
                centred[i, j] = centred[j, i] = self.n * sums[i, j] - self.total[i] * self.total[j]
        square = self.n * self.n
        cov = np.array([[c / square for c in row] for row in centred], float).reshape(dims, dims)
        _, vectors = np.linalg.eigh(cov) if dims else (None, np.zeros((0, 0)))
        self.vectors = vectors[:, ::-1][:, :components]
        trace = sum(centred[i, i] for i in range(dims))
        self.variance, self.explained = [], []
        for v in self.vectors.T:
            whole = np.array([int(round(c * 2.0 ** 52)) for c in v], object)
            up, length = int(whole @ centred @ whole), int(whole @ whole)
            self.variance.append(up / (length * square))
            self.explained.append(up / (length * trace) if trace else None)
        noise = dims * 2.0 ** -52 * max(self.variance, default=0.0)
        self.known = [e > noise for e in self.variance]
        self.mean = np.array([t / self.n for t in self.total], float)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """``(rows, components)``, NaN for a component without variance."""
        scale = np.array([1 / math.sqrt(e) if ok else math.nan for e, ok in zip(self.variance, self.known)])
        return (x - self.mean) @ self.vectors * scale

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Exact sums over dimensions of ``(n * x - S)**2``."""
        bound = self.n * largest(x) + max((abs(t) for t in self.total), default=0)
        kind = np.int64 if bound * bound * max(1, len(self.total)) < 1 << 63 else object
        apart = self.n * x.astype(kind) - self.total.astype(kind)
        return (apart * apart).sum(axis=1)


def padded(column, dims: int) -> np.ndarray:
    m = matrix(column)
    return np.pad(m, ((0, 0), (0, dims - m.shape[1])))


def projected(rows: DataFrame, fit: Fit) -> DataFrame:
    """``w0, w1, ...``: the whitened components of every row, those without variance left out."""
    own = [c for c, ok in enumerate(fit.known) if ok]

    def run(batches):
        for batch in batches:
            w = fit.whiten(padded(batch.column("x"), len(fit.total)))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, c]) for c in own], [f"w{c}" for c in own])

    return rows.select("x").mapInArrow(run, ", ".join(f"w{c} double" for c in own))


def identity_error(fit_list: DataFrame, fit: Fit) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    own = [c for c, ok in enumerate(fit.known) if ok]
    if not own:
        return None
    pairs = [(a, b) for a in own for b in own if a <= b]
    row = projected(fit_list, fit).agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(row[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` per row and component.

    ``deviation`` is exact, ``decimal(38, 0)`` (null beyond 38 digits).
    """
    rows = integers(vectors, id_col, vec_col, SCALE)
    fit_list = checkpointed(rows.select("x").distinct())
    fit = Fit(summed(fit_list.mapInArrow(scatter_parts, SUMS)), components)
    error = identity_error(fit_list, fit)
    count = fit.vectors.shape[1]

    def run(batches):
        for batch in batches:
            x = padded(batch.column("x"), len(fit.total))
            w = fit.whiten(x).ravel()
            rows = np.repeat(np.arange(len(x)), count)
            tiled = lambda values, kind: pa.array(list(values) * len(x), kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), tiled(range(1, count + 1), pa.int32()),
                 pa.array(np.full(len(rows), fit.n), pa.int64()), decimals(fit.deviation(x)).take(pa.array(rows)),
                 pa.array(w, pa.float64(), mask=np.isnan(w)), tiled(fit.explained, pa.float64()),
                 pa.array([error] * len(rows), pa.float64())],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = rows.mapInArrow(run, "id long, component int, n long, deviation decimal(38,0), whitened double, "
                               "explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)
