"""Helpers shared by the operators: sizes, blocks, and numpy text kernels.

Texts reach Python as Arrow string columns; the kernels below work on the
column's byte buffer directly (no per-row Python objects).
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of stored input that make one block of documents.
BLOCK_BYTES = 10 << 20
#: Bytes of text that a numpy kernel works on at a time (a longer text alone).
CHUNK_BYTES = 2 << 20
#: Sort key of rows without a document id: after every other row.
NO_ID = (1 << 63) - 1

# Odd constants of the 64-bit hashes.
_ROOT = np.uint64(0x9E3779B97F4A7C13)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plan_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Stored input bytes: the optimizer's estimate of a plain scan (its file sizes),
    else half the text's bytes, counted."""
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    if size < 1 << 50 and "Join" not in plan.toString():
        return size
    return (df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // 2


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_count(df: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of about ``block_bytes`` of stored input, one per shuffle partition at least."""
    return max(partitions(df.sparkSession), -(-plan_bytes(df) // block_bytes))


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """``(doc_id, text, block)`` hash-partitioned by block, and the block count.

    All rows of an id share a block.  A plan that uses the result in several
    branches shuffles the texts once (the exchange is reused).  A null text is
    empty, a null id sorts last.
    """
    n = block_count(docs)
    out = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = out.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int"))
    return out.repartition(n, "block"), n


def id_or_null(col: str = "doc_id"):
    """The id column as it was before ``blocks`` replaced its nulls."""
    return F.when(F.col(col) != NO_ID, F.col(col)).alias(col)


def free_names(columns: list[str], *names: str) -> list[str]:
    """Names for helper columns that clash with none of ``columns``, whatever their case."""
    taken, prefix = {c.lower() for c in columns}, "__"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]


def checkpoint_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a local session without it."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


# ---- kernels that run inside tasks ---------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (wraps modulo 2**64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * _ROOT) | np.uint64(1)


def starts_of(sorted_values: np.ndarray) -> np.ndarray:
    """Index of the first element of every run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1))


def unique_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sort(x)
    at = starts_of(s)
    return s[at], np.diff(np.append(at, len(s)))


def merge_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum ``counts`` by key; keys come out sorted."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    at = starts_of(s)
    return s[at], np.add.reduceat(counts[order], at) if len(at) else counts[:0]


def byte_view(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64) and bytes of an Arrow string or binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def chunk_rows(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges ``(i, j)`` of whole texts of about ``limit`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACED = np.ones(256, bool)
_SPACED[[0x20, 9, 10, 11, 12, 13]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[97:123] = _ALNUM[128:] = True
#: Bytes of the two word patterns: not white space; lower-case letters, digits and non-ASCII.
WORD_BYTES = {"spaced": _SPACED, "alnum": _ALNUM}


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(offsets: np.ndarray, data: np.ndarray, kind: str = "spaced"):
    """Start and end byte of every word, and the word index at which each text begins."""
    inside = WORD_BYTES[kind][data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    first = inside & (~before | cut[:-1])
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = inside & (~after | cut[1:])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BYTE_VALUES = constants(256, 1)
_BASE = np.uint64(0x5851F42D4C957F2B)
_BASE_INVERSE = np.uint64(pow(0x5851F42D4C957F2B, -1, 1 << 64))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums; ``span_hash`` takes any substring's hash from them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(len(data))[:-1], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray,
              inverse: np.ndarray | None = None) -> np.ndarray:
    inverse = powers(len(prefix) - 1, _BASE_INVERSE) if inverse is None else inverse
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of words (equal words, equal fingerprints, everywhere)."""
    return span_hash(prefix_hash(data), starts, ends)


def sequence_hashes(words: np.ndarray, k: int, seed: int = 2) -> np.ndarray:
    """Fingerprints of all runs of ``k`` consecutive words (of the whole array)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, c in enumerate(constants(k, seed)):
        total += words[j:j + n] * c
    return mix(total)


def pack(array: np.ndarray) -> bytes:
    """Bytes of an array, transposed by byte and compressed."""
    raw = np.ascontiguousarray(array)
    if not raw.size:
        return b""
    size = raw.itemsize
    flat = raw.view(np.uint8).reshape(-1, size).T.tobytes()
    return len(flat).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(flat, asbytes=True)


def unpack(blob: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    if not blob:
        return np.zeros(0, dtype)
    n = int.from_bytes(blob[:8], "little")
    flat = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], n, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def deltas(sorted_values: np.ndarray) -> np.ndarray:
    """Differences of a sorted integer array (the first one from zero)."""
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def undelta(d: np.ndarray) -> np.ndarray:
    return np.cumsum(d, dtype=d.dtype)


def cover_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal runs (touching intervals merge)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    at = np.flatnonzero(new)
    return starts[at], ends[np.append(at[1:] - 1, len(ends) - 1)]
