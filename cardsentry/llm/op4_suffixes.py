"""Suffix-array dedup: removes byte strings that already occurred.

Suffixes are ordered only through ``length`` bytes, by most-significant-digit
passes, and equal groups are exactly the repeated windows.  The first digit is an
anchor (a 32-byte string that the window picks by hash); suffixes whose anchor
occurs once retire there.  The second digit is the anchor with half of the rest
of the window, then digits of eight bytes follow (``repeats.radix``).  Windows
that repeat as whole bundles leave after the first pass.

A byte is removed if it lies in a window that also starts earlier: in a row with
a smaller id, or earlier in its own text.  Windows are judged on the input.

Defined cases: null text is empty; rows that repeat an id are separate texts in
order of their text; rows without an id come after all others; texts shorter than
a window keep everything; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import _BYTE_VALUES
from .repeats import Windows, _powers, _R, _R_INVERSE, id_of, repeated_ranges, window_starts

LENGTH = 100
#: Bytes of an anchor.
GRAM = 32
#: Bits of a position in the packed (hash, position) order of anchors.
_PLACE = np.uint64(30)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(length: int):
    def find(tokens: np.ndarray, first: np.ndarray):
        """Window starts with the place, size and key of their anchors: the leftmost
        of the grams with the least hash that lie in the window."""
        p = window_starts(first, length)
        if not len(p):
            return p, p, p, p.astype(np.uint64)
        n = len(tokens)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[tokens] * _powers(n, _R)[:-1], out=sums[1:], dtype=np.uint64)
        key = (sums[GRAM:] - sums[:-GRAM]) * _powers(n, _R_INVERSE)[:n - GRAM + 1]
        order = (key >> _PLACE << _PLACE) | np.arange(len(key), dtype=np.uint64)
        at = (sliding_min(order, length - GRAM + 1)[p] & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
        return p, at, np.full(len(p), GRAM), key[at]
    return find


def _bytes(offsets: np.ndarray, data: np.ndarray):
    return data, offsets


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept)`` per row.

    ``spans`` are the maximal removed byte runs ``(start, end)``, ``kept`` the
    remaining bytes (a run may cut a character).
    """
    if not 2 * GRAM <= length <= 255:
        raise ValueError(f"length must be from {2 * GRAM} to 255")

    def finish(ids, offsets, data, first, covered):
        size = np.diff(offsets)
        fresh = np.zeros(len(data) + 1, bool)
        fresh[offsets] = True
        before = np.concatenate(([False], covered[:-1])) if len(covered) else covered
        after = np.concatenate((covered[1:], [False])) if len(covered) else covered
        start = np.flatnonzero(covered & (~before | fresh[:-1]))
        end = np.flatnonzero(covered & (~after | fresh[1:])) + 1
        removed = np.concatenate(([0], np.cumsum(covered)))[offsets]
        lists = np.searchsorted(start, offsets)
        base = offsets[np.searchsorted(offsets, start, "right") - 1]
        spans = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(start - base), pa.array(end - base)], ["start", "end"]))
        kept = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer((offsets - removed).astype(np.int64)),
                                                                   pa.py_buffer(data[~covered].tobytes())])
        return pa.table({"doc_id": id_of(ids), "n_bytes": pa.array(size), "n_removed": pa.array(np.diff(removed)),
                         "spans": spans, "kept": kept.cast(pa.binary())})

    w = Windows(length, _bytes, anchors(length), True, "uint8")
    return repeated_ranges(w, docs, finish, "doc_id long, n_bytes long, n_removed long, "
                                            "spans array<struct<start:bigint,end:bigint>>, kept binary")
