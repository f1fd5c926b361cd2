"""Exact repeated windows over all documents, shared by the two substring operators.

Every window of ``length`` tokens has one anchor, chosen by the window's content
alone, so equal windows have equal anchors at equal places.  Consecutive windows
with the same anchor form a bundle: a short token range that stands for all of
them.  Four steps find the windows that also start in front of themselves:

1. Blocks of documents send each bundle's anchor and fingerprint to buckets.
2. Buckets drop anchors that occur once, settle bundles that repeat as a whole
   and ask for the tokens of bundles that share an anchor but differ.
3. Blocks send those tokens, routed by the anchor and the half of the context
   that each window surely holds, so a frequent anchor does not meet in one task.
4. Buckets order the windows token by token; equal groups are the repeats.

Equal bundles are merged within a block before anything is sent, so a hot
passage costs a row per block.  Steps travel as packed rows; a plan shuffles the
texts once and reuses that exchange.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NO_ID, blocks, byte_view, constants, deltas, mix, pack, partitions, plan_bytes, starts_of,
                     undelta, unpack)

#: Stored input bytes behind one bucket, at least one bucket per shuffle partition.
BUCKET_BYTES = 64 << 20
#: Tokens handled at a time (bounds a task's memory, also within a long text).
SEGMENT = 1 << 20
#: What a row carries: bundles for a bucket, settled ranges of a block, requests to a block, tokens.
BUNDLES, RANGES, REQUESTS, TOKENS = 0, 1, 2, 3
ROW = ("kind int, bucket int, block int, a binary, b binary, c binary, d binary, e binary, f binary, g binary")
_NAMES = ["kind", "bucket", "block", "a", "b", "c", "d", "e", "f", "g"]
_SHAPE = constants(5, 7)


@dataclass(frozen=True)
class Windows:
    """What windows are made of.

    ``tokens(offsets, data)`` gives a block's token values (unsigned integers)
    and the token at which each text begins.  ``anchors(tokens, first)`` gives for
    every window start the index, first token, size and key of its anchor (see
    ``Anchors``).  ``own_document``: a window is also repeated by an earlier start
    in its own document.
    """

    length: int
    tokens: Callable
    anchors: Callable
    own_document: bool
    dtype: str


def in_order(table: pa.Table):
    """A block's rows by id, then text: ids, offsets and bytes of the texts."""
    ids = table.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    if len(ids) > 1 and (np.diff(ids[order]) == 0).any():
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    else:
        table = table.take(pa.array(order))
    return table.column("doc_id").to_numpy(), *byte_view(table.column("text"))


def _row(kind, bucket, block, *arrays):
    packed = [pack(x) for x in arrays] + [None] * (7 - len(arrays))
    return (kind, bucket, block, *packed)


def _batches(rows, size: int = 64):
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int32())]
                       + [(n, pa.binary()) for n in "abcdefg"])
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + size]), schema.types)],
                                         schema=schema)


def _table(rows) -> pa.Table:
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int32())]
                       + [(n, pa.binary()) for n in "abcdefg"])
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema) \
        if rows else schema.empty_table()


def segments(first: np.ndarray, length: int):
    """Token ranges to look at: whole texts together, or overlapping pieces of a long one."""
    i, n = 0, len(first) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(first, first[i] + SEGMENT, "right")) - 1)
        if j == i + 1 and first[j] - first[i] > SEGMENT:
            for a in range(int(first[i]), int(first[j]) - length + 1, SEGMENT):
                b = min(a + SEGMENT + length - 1, int(first[j]))
                yield a, b, np.array([0, b - a])
        else:
            yield int(first[i]), int(first[j]), first[i:j + 1] - first[i]
        i = j


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """All window starts of a segment."""
    room = np.maximum(np.diff(first) - length + 1, 0)
    skip = np.concatenate(([0], np.cumsum(np.diff(first) - room)))[:-1]
    return np.arange(int(room.sum())) + np.repeat(skip, room) if room.sum() else np.zeros(0, np.int64)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base & (2 ** 64 - 1), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_R = 0xD1342543DE82EF95
_R_INVERSE = pow(_R, -1, 1 << 64)


class Prints:
    """Fingerprints of token ranges of a segment."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(len(values), _R)[:-1], out=self.sums[1:], dtype=np.uint64)
        self.inverse = _powers(len(values), _R_INVERSE)

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def _shaped(prints: np.ndarray, *sizes) -> np.ndarray:
    total = prints * _SHAPE[0]
    for c, s in zip(_SHAPE[1:], sizes):
        total = total + np.asarray(s).astype(np.uint64) * c
    return mix(total)


def _repeated(same: np.ndarray, doc: np.ndarray, pos: np.ndarray, own_document: bool):
    """Order by (same, doc, pos) and which of the ordered ones have an equal in front of them."""
    order = np.lexsort((pos, doc, same))
    s, d = same[order], doc[order]
    at = starts_of(s)
    size = np.diff(np.append(at, len(s)))
    if own_document:
        later = np.ones(len(s), bool)
        later[at] = False
    else:
        later = d > np.repeat(d[at], size) if len(s) else np.zeros(0, bool)
    return order, later


def _find_bundles(w: Windows, values, first):
    """Start, number of windows, anchor offset and size, anchor key and variant of every bundle."""
    out = []
    for a, b, local in segments(first, w.length):
        part = values[a:b]
        p, at, size, key = w.anchors(part, local)
        if not len(p):
            continue
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (size[1:] != size[:-1])
                                             | (p[1:] != p[:-1] + 1))))
        n = np.diff(np.append(new, len(p)))
        lo, at, size, key = p[new], at[new], size[new], key[new]
        prints = Prints(_values(part))
        variant = _shaped(prints(lo, lo + n - 1 + w.length) + key, n, at - lo)
        out.append((lo + a, n, at - lo, size, key, variant))
    if not out:
        zero = np.zeros(0, np.int64)
        return zero, zero, zero, zero, zero.astype(np.uint64), zero.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _values(tokens: np.ndarray) -> np.ndarray:
    from .common import _BYTE_VALUES

    return _BYTE_VALUES[tokens] if tokens.dtype == np.uint8 else tokens


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint8)


def repeated_ranges(w: Windows, docs: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """``finish(ids, offsets, data, first, covered)`` per block, where ``covered``
    marks the tokens of windows that repeat; its tables make up the result."""
    texts, n_blocks = blocks(docs)
    n_buckets = max(partitions(docs.sparkSession), plan_bytes(docs) // BUCKET_BYTES)

    def owner(ids, first, pos):
        return ids[np.searchsorted(first, pos, "right") - 1]

    def by_bucket(key):
        return (key % np.uint64(n_buckets)).astype(np.int64)

    def split(rows, kind, block, bucket, columns):
        """One packed row per bucket of entries that come in order of position."""
        order = np.argsort(bucket, kind="stable")
        at = starts_of(bucket[order])
        for i, j in zip(at, np.append(at[1:], len(order))):
            part = order[i:j]
            rows.append(_row(kind, int(bucket[part[0]]), block, *[f(c[part]) for c, f in columns]))

    def ranges(rows, block, pos, size):
        if len(pos):
            order = np.argsort(pos, kind="stable")
            rows.append(_row(RANGES, block % n_buckets, block, deltas(pos[order]), size[order].astype(np.uint16)))

    same = lambda x: x

    def send_bundles(key, table):
        block = key[0].as_py()
        ids, offsets, data = in_order(table)
        values, first = w.tokens(offsets, data)
        pos, n, off, size, key, variant = _find_bundles(w, values, first)
        doc = owner(ids, first, pos) if len(pos) else pos
        rows = []
        order, later = _repeated(variant, doc, pos, w.own_document)
        settled = order[later]
        ranges(rows, block, pos[settled], n[settled] + w.length - 1)
        rest = np.sort(order[~later])
        pos, n, off, size, key, variant, doc = (c[rest] for c in (pos, n, off, size, key, variant, doc))
        split(rows, BUNDLES, block, by_bucket(key), (
            (key, same), (variant, same), (doc, deltas), (pos, deltas), (n, _small), (off, _small), (size, _small)))
        return _table(rows)

    def settle(batches):
        rows, key, variant, doc, pos, n, off, size, block = [], [], [], [], [], [], [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] != BUNDLES:
                    yield from _batches([tuple(r[c] for c in _NAMES)])
                    continue
                k = unpack(r["a"], np.uint64)
                key.append(k)
                variant.append(unpack(r["b"], np.uint64))
                doc.append(undelta(unpack(r["c"], np.int64)))
                pos.append(undelta(unpack(r["d"], np.int64)))
                n.append(unpack(r["e"], np.uint8))
                off.append(unpack(r["f"], np.uint8))
                size.append(unpack(r["g"], np.uint8))
                block.append(np.full(len(k), r["block"], np.int32))
        if not key:
            return
        key = np.concatenate(key)
        shared = _shared(key)
        key = key[shared]
        variant, doc, pos, n, off, size, block = (np.concatenate(c)[shared] for c in (variant, doc, pos, n, off, size, block))
        order, later = _repeated(variant, doc, pos, w.own_document)
        out = order[later]
        for b, part in _groups(block, out):
            ranges(rows, b, pos[part], n[part].astype(np.int64) + w.length - 1)
        rest = order[~later]
        rest = rest[_differing(key[rest], variant[rest])]
        for b, part in _groups(block, rest):
            part = part[np.argsort(pos[part], kind="stable")]
            rows.append(_row(REQUESTS, 0, b, deltas(pos[part]), n[part], off[part], size[part]))
        yield from _batches(rows)

    def send_tokens(key, table, asked):
        block = key[0].as_py()
        rows, requests = [], []
        for r in asked.to_pylist():
            if r["kind"] == REQUESTS:
                requests.append((undelta(unpack(r["a"], np.int64)), *(unpack(r[c], np.uint8).astype(np.int64) for c in "bcd")))
            else:
                rows.append(tuple(r[c] for c in _NAMES))
        if not requests:
            return _table(rows)
        ids, offsets, data = in_order(table)
        values, first = w.tokens(offsets, data)
        pos, n, off, size = (np.concatenate(c) for c in zip(*requests))
        order = np.argsort(pos, kind="stable")
        pos, n, off, size = (c[order] for c in (pos, n, off, size))
        anchor = pos + off
        half = (w.length - size + 1) // 2
        cut = np.clip(anchor - half + 1 - pos, 0, n)  # windows that hold `half` tokens before the anchor
        left, right = cut > 0, cut < n
        start = np.concatenate((pos[left], (pos + cut)[right]))
        count = np.concatenate((cut[left], (n - cut)[right]))
        k_from = np.concatenate(((anchor - half)[left], anchor[right]))
        k_to = np.concatenate(((anchor + size)[left], (anchor + w.length - half + 1)[right]))
        order = np.argsort(start, kind="stable")
        start, count, k_from, k_to = (c[order] for c in (start, count, k_from, k_to))
        keys, variants = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
        for a, b, _ in segments(first, w.length):
            i, j = np.searchsorted(start, a), np.searchsorted(start, b)
            here = np.arange(i, j)
            here = here[(k_to[here] <= b) & (start[here] + count[here] + w.length - 1 <= b)]
            if len(here):
                prints = Prints(_values(values[a:b]))
                keys[here] = _shaped(prints(k_from[here] - a, k_to[here] - a), k_to[here] - k_from[here])
                variants[here] = _shaped(prints(start[here] - a, start[here] + count[here] + w.length - 1 - a) + keys[here],
                                         count[here], k_from[here] - start[here])
        doc = owner(ids, first, start)
        order, later = _repeated(variants, doc, start, w.own_document)
        settled = order[later]
        ranges(rows, block, start[settled], count[settled] + w.length - 1)
        rest = np.sort(order[~later])
        start, count, keys, doc, rel = start[rest], count[rest], keys[rest], doc[rest], (k_from - start)[rest]

        def spell(part):
            size = count[part] + w.length - 1
            at = np.repeat(start[part] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            return values[at]

        split(rows, TOKENS, block, by_bucket(keys), (
            (keys, same), (doc, deltas), (start, deltas), (count, _small), (rel, lambda x: x.astype(np.int16)),
            (np.arange(len(start)), spell)))
        return _table(rows)

    def compare(batches):
        keys, doc, pos, count, rel, block, spelled = [], [], [], [], [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] != TOKENS:
                    yield from _batches([tuple(r[c] for c in _NAMES)])
                    continue
                k = unpack(r["a"], np.uint64)
                keys.append(k)
                doc.append(undelta(unpack(r["b"], np.int64)))
                pos.append(undelta(unpack(r["c"], np.int64)))
                count.append(unpack(r["d"], np.uint8).astype(np.int64))
                rel.append(unpack(r["e"], np.int16).astype(np.int64))
                spelled.append(unpack(r["f"], w.dtype))
                block.append(np.full(len(k), r["block"], np.int32))
        if not keys:
            return
        keys, doc, pos, count, rel, block, spelled = (np.concatenate(c) for c in (keys, doc, pos, count, rel, block, spelled))
        size = count + w.length - 1
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        live = np.flatnonzero(_shared(keys))
        n = count[live]
        entry = np.repeat(live, n)
        step = np.arange(len(entry)) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(n) else entry
        # most significant digit: the routing key and where in the window it lies
        group = _shaped(keys[entry], rel[entry] - step + w.length)
        keep = _shared(group)
        entry, step, group = entry[keep], step[keep], group[keep]
        entry, step, group = radix(spelled, begin[entry] + step, group, w.length, (entry, step))
        order, later = _repeated(group, doc[entry], pos[entry] + step, w.own_document)
        entry, start = entry[order[later]], (pos[entry] + step)[order[later]]
        rows = []
        for b, part in _groups(block[entry], np.arange(len(entry))):
            ranges(rows, b, start[part], np.full(len(part), w.length))
        yield from _batches(rows)

    def close(key, table, settled):
        ids, offsets, data = in_order(table)
        values, first = w.tokens(offsets, data)
        edge = np.zeros(len(values) + 1, np.int32)
        rows = [(undelta(unpack(r["a"], np.int64)), unpack(r["b"], np.uint16)) for r in settled.to_pylist()]
        if rows:
            pos, size = (np.concatenate(c) for c in zip(*rows))
            np.add.at(edge, pos, 1)
            np.add.at(edge, pos + size, -1)
        return finish(ids, offsets, data, first, np.cumsum(edge[:-1]) > 0)

    grouped = texts.groupBy("block")
    sent = grouped.applyInArrow(send_bundles, ROW).repartitionById(n_buckets, F.col("bucket"))
    asked = sent.mapInArrow(settle, ROW)
    told = grouped.cogroup(asked.groupBy("block")).applyInArrow(send_tokens, ROW).repartitionById(n_buckets, F.col("bucket"))
    return grouped.cogroup(told.mapInArrow(compare, ROW).groupBy("block")).applyInArrow(close, schema)


def radix(tokens: np.ndarray, start: np.ndarray, group: np.ndarray, length: int, carried):
    """Depth-limited radix sort of the suffixes that begin at ``start``.

    Passes take digits of eight bytes from the most significant on.  A pass splits
    every group by its next digit and suffixes left alone retire, so only suffixes
    that agree so far are read further.  What remains after ``length`` tokens are
    the groups of equal windows.
    """
    width = 8 // tokens.itemsize
    if width > 1:
        raw = np.concatenate((tokens, np.zeros(8, np.uint8)))
        digits = np.ndarray((len(tokens) + 1,), ">u8", raw.tobytes(), 0, (1,))
    else:
        digits = tokens
    for depth in range(0, length, width):
        if not len(start):
            break
        digit = digits[start + depth].astype(np.uint64)
        if length - depth < width:
            digit >>= np.uint64(8 * (width - (length - depth)))
        group = mix(group * _SHAPE[3] + _shaped(digit, depth))  # chained: the order of the digits counts
        alive = _shared(group)
        if not alive.all():
            start, group = start[alive], group[alive]
            carried = tuple(c[alive] for c in carried)
    return (*carried, group)


def _shared(x: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    equal = s[1:] == s[:-1]
    out = np.zeros(len(x), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


def _differing(key: np.ndarray, variant: np.ndarray) -> np.ndarray:
    """Entries whose key has more than one variant."""
    order = np.lexsort((variant, key))
    k, v = key[order], variant[order]
    at = starts_of(k)
    new = np.ones(len(k), np.int64)
    new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
    kinds = np.add.reduceat(new, at) if len(at) else at
    many = np.repeat(kinds > 1, np.diff(np.append(at, len(k))))
    out = np.zeros(len(key), bool)
    out[order] = many
    return out


def _groups(block: np.ndarray, part: np.ndarray):
    """``part`` by block."""
    part = part[np.argsort(block[part], kind="stable")]
    at = starts_of(block[part])
    for i, j in zip(at, np.append(at[1:], len(part))):
        yield int(block[part[i]]), part[i:j]


def id_of(ids: np.ndarray) -> pa.Array:
    """Ids as they were given: the key of rows without one becomes null again."""
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)
