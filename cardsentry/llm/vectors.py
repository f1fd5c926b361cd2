"""Integer vectors and exact sums of them, shared by the operators on embeddings."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base-2**32 digits that carry an exact sum through Spark (the last one is signed).
LIMBS = 6
DIGITS = [f"d{i}" for i in range(LIMBS)]
SUMS = "i int, j int, " + ", ".join(f"{d} long" for d in DIGITS)


def integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int, size: int | None = None) -> DataFrame:
    """``(id, x)``: ``x = floor(scale * component)`` of the vectors whose entries are all finite.

    A scaled component beyond 64 bits takes the nearest 64-bit value.  With ``size``
    only vectors of that many components stay.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    if size is not None:
        rows = rows.filter(F.size("v") == size)
    return rows.select("id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("x"))


def matrix(lists) -> np.ndarray:
    """Rows of an Arrow list column as a matrix; missing trailing components are zero."""
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    width = int(size.max(initial=0))
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width)[None, :] < size[:, None]] = flat
    return out


def largest(x: np.ndarray) -> int:
    """Greatest absolute value, as a Python integer."""
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


def digits(value: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & 0xFFFFFFFF)
        value >>= 32
    return [*out, value]


def sums_batch(keyed) -> pa.RecordBatch:
    """Arrow rows ``(i, j, digits)`` of ``((i, j), integer)`` entries."""
    rows = [(i, j, *digits(int(value))) for (i, j), value in keyed]
    kinds = [pa.int32(), pa.int32()] + [pa.int64()] * LIMBS
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["i", "j", *DIGITS])


def summed(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by ``(i, j)``.  The number of keys, not of rows, bounds what the driver gets."""
    rows = parts.groupBy("i", "j").agg(*[F.sum(d).alias(d) for d in DIGITS]).collect()
    return {(r.i, r.j): sum(r[d] << 32 * n for n, d in enumerate(DIGITS)) for r in rows}


def decimals(values: np.ndarray) -> pa.Array:
    """Exact ``decimal(38, 0)`` of an integer array (int64 or Python integers); null beyond 38 digits."""
    if values.dtype != object:
        return pa.array(values, pa.int64()).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(int(v)) if abs(int(v)) < 10 ** 38 else None for v in values], pa.decimal128(38, 0))
