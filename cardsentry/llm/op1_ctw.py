"""Language-model scoring by context-tree weighting over bytes.

A lower-cased text is a sequence of bytes and one end mark.  Every byte is coded
as eight binary decisions; a decision has a node for every depth 0 to ``depth`` of
the preceding bytes.  A node holds a Krichevsky-Trofimov estimate of its bit
counts, and context-tree weighting mixes the estimates of all depths: a node's
weight against its subtree is its block probability over that of its children,
from the training texts.  The score is the log10 probability of the whole text.

The tree is distributed by its two nearest context bytes:

1. Blocks of documents count their distinct (context, byte) strings and send them
   to buckets, merged within the block.
2. Buckets merge the counts and weigh their subtrees from the leaves to depth two.
3. Depths one and zero (at most 256 * 255 nodes) are summed by Spark and solved on
   the driver, and sent to all tasks.
4. Buckets mix the depths for every string and answer the blocks that asked; blocks
   add up their texts.  The words of the unigram base travel the same way.

No task holds the whole model, so what is gathered grows with the corpus.

Defined cases: null text is empty and scores its end mark; a row without an id is
a training text if the remainder of the empty id's checksum is not the held-out
one; rows that repeat an id are separate texts; without training texts every bit
has probability one half; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NO_ID, blocks, checkpointed, chunk_rows, deltas, lower, merge_counts, mix, pack, partitions,
                     plan_bytes, starts_of, undelta, unpack)
from .repeats import id_of, in_order

DEPTH = 5
#: Mark of a text's end and of what lies before its start; no byte of UTF-8.
MARK = 255
HELD_OUT, FOLDS = 1, 5
CHUNK = 2 << 20
BUCKET_BYTES = 64 << 20
STRINGS, WORDS, TOP, ASK, STAT = 0, 1, 2, 3, 4
ROW = "kind int, bucket int, block int, a binary, b binary, c binary"
_NAMES = ["kind", "bucket", "block", "a", "b", "c"]
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int32()),
                     ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_SLOTS = 21


def trains(doc_id: int) -> bool:
    return zlib.crc32(b"" if doc_id == NO_ID else str(doc_id).encode()) % FOLDS != HELD_OUT


def _rows(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)


def strings(offsets: np.ndarray, data: np.ndarray, depth: int):
    """``(codes, text number)`` of all positions, piece by piece.

    A code holds the preceding bytes, nearest first, then the byte itself, so
    sorted codes are in the order of the context tree.
    """
    for i, j in chunk_rows(offsets, CHUNK):
        size = np.diff(offsets[i:j + 1])
        text = np.repeat(np.arange(j - i), size + depth + 1)
        stream = np.full(len(text), MARK, np.uint8)
        begin = np.concatenate(([0], np.cumsum(size + depth + 1)[:-1]))
        local = offsets[i:j] - offsets[i]
        stream[np.arange(int(size.sum())) + np.repeat(begin + depth - local, size)] = data[offsets[i]:offsets[j]]
        coded = np.ones(len(text), bool)
        coded[(begin[:, None] + np.arange(depth)[None, :]).ravel()] = False
        for a in range(depth, len(stream), CHUNK):
            b = min(a + CHUNK, len(stream))
            code = stream[a:b].astype(np.uint64)
            for k in range(1, depth + 1):
                code |= stream[a - k:b - k].astype(np.uint64) << np.uint64(8 * (depth + 1 - k))
            keep = coded[a:b]
            yield code[keep], text[a:b][keep] + i


def count_strings(offsets, data, train: np.ndarray, depth: int):
    """Distinct codes of a block and how often each occurs in training texts."""
    codes, counts = [], []
    for code, text in strings(offsets, data, depth):
        marked = (code << np.uint64(1)) | train[text].astype(np.uint64)
        marked.sort()
        at = starts_of(marked)
        n = np.diff(np.append(at, len(marked)))
        marked = marked[at]
        codes.append(marked >> np.uint64(1))
        counts.append(np.where(marked & np.uint64(1), n, 0))
    if not codes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return merge_counts(np.concatenate(codes), np.concatenate(counts))


# ---- the tree ------------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma of positive values by Stirling's series after a shift of eight."""
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Level:
    """The (context, byte) strings of one depth: sorted codes, counts, place in the level above."""

    def __init__(self, codes, counts):
        self.codes, self.counts, self.above = codes, counts.astype(np.float64), None

    def shorter(self, depth: int) -> Level:
        """The next shorter contexts: the farthest byte leaves the code."""
        code = ((self.codes >> np.uint64(16)) << np.uint64(8)) | (self.codes & np.uint64(255))
        order = np.argsort(code, kind="stable")
        at = starts_of(code[order])
        place = np.zeros(len(code), np.int64)
        if len(at):
            place[at[1:]] = 1
        self.above = np.empty(len(code), np.int64)
        self.above[order] = np.cumsum(place)
        return Level(code[order][at], np.add.reduceat(self.counts[order], at) if len(at) else self.counts)

    def nodes(self, bit: int):
        """Nodes of the ``bit``-th decision: node of every code, first code and bit counts of every node."""
        shift = np.uint64(8 - bit)
        at = starts_of(self.codes >> shift)
        mark = np.zeros(len(self.codes), np.int64)
        if len(at):
            mark[at[1:]] = 1
        is_one = (self.codes >> np.uint64(7 - bit)) & np.uint64(1) == 1
        if not len(at):
            return mark, at, np.zeros(0), np.zeros(0)
        ones = np.add.reduceat(np.where(is_one, self.counts, 0), at)
        return np.cumsum(mark), at, np.add.reduceat(self.counts, at) - ones, ones


def levels(codes, counts, depth: int, least: int) -> list[Level]:
    """Levels ``least`` to ``depth`` of a subtree's strings."""
    out = [Level(codes, counts)]
    for d in range(depth, least, -1):
        out.append(out[-1].shorter(d))
    return out[::-1]


def weigh(tree: list[Level], bit: int):
    """Per level: nodes, ln block probability (weighted), and each node's stop weight."""
    out, below = [None] * len(tree), None
    for d in range(len(tree) - 1, -1, -1):
        node, at, zeros, ones = tree[d].nodes(bit)
        own = log_kt(zeros, ones)
        if below is None:
            total, stop = own, np.ones(len(own))
        else:
            child_at, child_total = below
            parent = node[tree[d + 1].above[child_at]]
            inner = np.bincount(parent, weights=child_total, minlength=len(at))
            total = np.logaddexp(own, inner) - np.log(2)
            stop = 1 / (1 + np.exp(np.clip(inner - own, -700, 700)))
        out[d] = (node, at, zeros, ones, total, stop)
        below = (at, total)
    return out


def mixed(tree: list[Level], weights) -> np.ndarray:
    """Probability of a one at the decision, per string of the deepest level."""
    value = left = None
    for d, (node, at, zeros, ones, _, stop) in enumerate(weights):
        kt = (ones + 0.5) / (zeros + ones + 1)
        if value is None:
            value, left = stop * kt, 1 - stop
        else:
            parent = weights[d - 1][0][tree[d].above[at]]
            value, left = value[parent] + left[parent] * stop * kt, left[parent] * (1 - stop)
    return value[weights[-1][0]] if len(weights[-1][1]) else np.zeros(0)


def _prefix(codes: np.ndarray, bit: int) -> np.ndarray:
    """Place of a decision in the byte's binary tree, from 1 to 255."""
    return (1 << bit) | ((codes & np.uint64(255)) >> np.uint64(8 - bit)).astype(np.int64)


def subtree_sums(codes, counts, depth: int):
    """What depth one needs of a bucket: ``(node, zeros, ones, ln probability)``,
    node = nearest byte * 256 + decision."""
    tree, out = levels(codes, counts, depth, 2), []
    for bit in range(8):
        _, at, zeros, ones, total, _ = weigh(tree, bit)[0]
        own = tree[0].codes[at]
        node = (own >> np.uint64(16)).astype(np.int64) * 256 + _prefix(own, bit)
        order = np.argsort(node, kind="stable")
        first = starts_of(node[order])
        if len(first):
            out.append((node[order][first], *(np.add.reduceat(c[order], first) for c in (zeros, ones, total))))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), *[np.zeros(0)] * 3]


def solve_top(node, zeros, ones, inner):
    """Mixture of depths zero and one per node: probability part and the weight left for depth two."""
    own = log_kt(zeros, ones)
    total = np.logaddexp(own, inner) - np.log(2)
    stop = 1 / (1 + np.exp(np.clip(inner - own, -700, 700)))
    decision = node % 256
    sums = [np.bincount(decision, weights=x, minlength=256) for x in (zeros, ones, total)]
    root = log_kt(sums[0], sums[1])
    root_stop = 1 / (1 + np.exp(np.clip(sums[2] - root, -700, 700)))
    root_kt = (sums[1] + 0.5) / (sums[0] + sums[1] + 1)
    value, left = np.full(65536, 0.5), np.zeros(65536)
    value[node] = root_stop[decision] * root_kt[decision] \
        + (1 - root_stop[decision]) * stop * (ones + 0.5) / (zeros + ones + 1)
    left[node] = (1 - root_stop[decision]) * (1 - stop)
    return value, left


def code_lengths(codes, counts, depth: int, top) -> np.ndarray:
    """log10 probability of the byte in every (context, byte) string."""
    tree = levels(codes, counts, depth, 2)
    nearest = (codes >> np.uint64(8 * depth)).astype(np.int64) * 256
    out = np.zeros(len(codes))
    for bit in range(8):
        one = mixed(tree, weigh(tree, bit))
        node = nearest + _prefix(codes, bit)
        one = top[0][node] + top[1][node] * one
        is_one = (codes >> np.uint64(7 - bit)) & np.uint64(1) == 1
        out += np.log10(np.maximum(np.where(is_one, one, 1 - one), 1e-300))
    return out


# ---- words of the unigram base -------------------------------------------------------

def _spell(words: list[bytes]) -> bytes:
    raw = b" ".join(words)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unspell(blob: bytes) -> list[bytes]:
    n = int.from_bytes(blob[:8], "little")
    return pa.Codec("zstd").decompress(blob[8:], n, asbytes=True).split(b" ") if n else []


class Table:
    """Values of codes by a hashed slot; codes that lose their slot are searched."""

    def __init__(self, codes, values):
        order = np.argsort(codes, kind="stable")
        self.codes, self.values = codes[order], values[order]
        self.shift = np.uint64(64 - max(_SLOTS, int(len(codes)).bit_length() + 2))
        self.slots = np.zeros(1 << int(64 - self.shift), np.int32)
        at = self._slot(self.codes)
        self.slots[at] = np.arange(len(codes), dtype=np.int32)
        lost = self.slots[at] != np.arange(len(codes))
        self.lost, self.lost_values = self.codes[lost], self.values[lost]

    def _slot(self, codes):
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, codes):
        at = self.slots[self._slot(codes)]
        out = self.values[at]
        missed = np.flatnonzero(self.codes[at] != codes)
        if len(missed):
            out[missed] = self.lost_values[np.searchsorted(self.lost, codes[missed])]
        return out


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte)``."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be from 2 to 6")
    spark = docs.sparkSession
    texts, _ = blocks(docs)
    n_buckets = max(partitions(spark), plan_bytes(docs) // BUCKET_BYTES)
    grouped = texts.groupBy("block")

    def gather(key, table):
        block = key[0].as_py()
        ids, offsets, data = in_order(table)
        data = lower(data)
        train = np.array([trains(int(i)) for i in ids], bool)
        rows = []
        codes, counts = count_strings(offsets, data, train, depth)
        bucket = (mix(codes >> np.uint64(8 * (depth - 1))) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = starts_of(bucket[order])
        for i, j in zip(at, np.append(at[1:], len(order))):
            part = order[i:j]
            rows.append((STRINGS, int(bucket[part[0]]), block, pack(deltas(codes[part])), pack(counts[part]), None))
        words = Counter()
        for k in range(len(ids)):
            split = data[offsets[k]:offsets[k + 1]].tobytes().split()
            if train[k]:
                words.update(split)
            else:
                for x in split:
                    words.setdefault(x, 0)
        by_bucket = {}
        for x in words:
            by_bucket.setdefault(zlib.crc32(x) % n_buckets, []).append(x)
        for b, own in by_bucket.items():
            rows.append((WORDS, b, block, _spell(own), pack(np.array([words[x] for x in own], np.int64)), None))
        rows.append((STAT, block % n_buckets, block, pack(np.array([train.sum()], np.int64)), None, None))
        return pa.Table.from_batches([_rows(rows)])

    def merge(batches):
        codes, counts, blocks_, words, asked = [], [], [], Counter(), []
        bucket, train_texts = 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                bucket = r["bucket"]
                if r["kind"] == STRINGS:
                    codes.append(undelta(unpack(r["a"], np.uint64)))
                    counts.append(unpack(r["b"], np.int64))
                    blocks_.append(r["block"])
                elif r["kind"] == WORDS:
                    own = _unspell(r["a"])
                    for x, n in zip(own, unpack(r["b"], np.int64).tolist()):
                        words[x] += n
                    asked.append((r["block"], r["a"]))
                else:
                    train_texts += int(unpack(r["a"], np.int64)[0])
        if codes:
            all_codes, all_counts = merge_counts(np.concatenate(codes), np.concatenate(counts))
            yield _rows([(STRINGS, bucket, -1, pack(deltas(all_codes)), pack(all_counts), None)])
            sums = subtree_sums(all_codes, all_counts, depth)
            yield _rows([(TOP, bucket, -1, pack(sums[0]), pack(np.stack(sums[1:])), None)])
            for block, own in zip(blocks_, codes):
                place = np.searchsorted(all_codes, own)
                yield _rows([(ASK, bucket, block, pack(deltas(place)), None, None)])
        for block, blob in asked:
            n = np.array([words[x] for x in _unspell(blob)], np.int64)
            yield _rows([(WORDS, bucket, block, blob, pack(n), None)])
        known = sum(1 for n in words.values() if n)
        yield _rows([(STAT, bucket, -1, pack(np.array([train_texts, known, sum(words.values())], np.int64)), None, None)])

    model = checkpointed(grouped.applyInArrow(gather, ROW).repartitionById(n_buckets, F.col("bucket")).mapInArrow(merge, ROW))

    def top_rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                node = unpack(r["a"], np.int64)
                if len(node):
                    zeros, ones, inner = unpack(r["b"], np.float64).reshape(3, -1)
                    yield pa.RecordBatch.from_pydict({"node": node, "zeros": zeros, "ones": ones, "inner": inner})

    def stat_rows(batches):
        for batch in batches:
            for blob in batch.column("a").to_pylist():
                yield pa.RecordBatch.from_pydict({n: [int(v)] for n, v in zip(
                    ("texts", "known", "words"), unpack(blob, np.int64))})

    # at most 256 * 255 nodes, whatever the corpus
    top = (model.filter(F.col("kind") == TOP).mapInArrow(top_rows, "node long, zeros double, ones double, inner double")
           .groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("inner")).orderBy("node").collect())
    node = np.array([r[0] for r in top], np.int64)
    solved = solve_top(node, *(np.array([r[k] for r in top], np.float64) for k in (1, 2, 3)))
    stat = (model.filter(F.col("kind") == STAT).mapInArrow(stat_rows, "texts long, known long, words long")
            .agg(F.sum("texts"), F.sum("known"), F.sum("words")).first())
    train_texts, known, n_words = (int(x or 0) for x in stat)
    n_train, distinct = n_words + train_texts, known + (train_texts > 0)
    shared = spark.sparkContext.broadcast(solved)  # 65,536 nodes, twice eight bytes each

    def answer(batches):
        codes = lengths = None
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == STRINGS:
                    codes = undelta(unpack(r["a"], np.uint64))
                    lengths = code_lengths(codes, unpack(r["b"], np.int64), depth, shared.value).astype(np.float32)
                elif r["kind"] == ASK:
                    place = undelta(unpack(r["a"], np.int64))
                    yield _rows([(STRINGS, r["bucket"], r["block"], pack(deltas(codes[place])), pack(lengths[place]), None)])
                elif r["kind"] == WORDS:
                    yield _rows([tuple(r[c] for c in _NAMES)])

    def add_up(key, table, answers):
        ids, offsets, data = in_order(table)
        data = lower(data)
        codes, lengths, base = [], [], {}
        scale = n_train + 0.5 * (distinct + 1)
        for r in answers.to_pylist():
            if r["kind"] == STRINGS:
                codes.append(undelta(unpack(r["a"], np.uint64)))
                lengths.append(unpack(r["b"], np.float32))
            else:
                base.update(zip(_unspell(r["a"]), np.log10((unpack(r["b"], np.int64) + 0.5) / scale).tolist()))
        n = len(ids)
        total = np.zeros(n)
        if codes:
            lookup = Table(np.concatenate(codes), np.concatenate(lengths))
            for code, text in strings(offsets, data, depth):
                total += np.bincount(text, weights=lookup[code], minlength=n)
        unknown, end = np.log10(0.5 / scale), np.log10((train_texts + 0.5) / scale)
        n_tokens, n_known, plain = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        for k in range(n):
            split = data[offsets[k]:offsets[k + 1]].tobytes().split()
            values = np.fromiter(map(base.__getitem__, split), np.float64, len(split))
            n_tokens[k] = len(split) + 1
            n_known[k] = int((values > unknown + 1e-9).sum()) + (train_texts > 0)
            plain[k] = values.sum() + end
        size = np.diff(offsets)
        return pa.table({"doc_id": id_of(ids), "held_out": pa.array([not trains(int(i)) for i in ids], pa.bool_()),
                         "n_tokens": n_tokens, "n_known": n_known, "train_tokens": np.full(n, n_train, np.int64),
                         "base_score": plain, "score": total, "n_bytes": size,
                         "bits_per_byte": -total / np.log10(2) / (size + 1)})

    asked = model.filter(F.col("kind").isin(STRINGS, ASK, WORDS)).mapInArrow(answer, ROW)
    return grouped.cogroup(asked.groupBy("block")).applyInArrow(
        add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, n_bytes long, bits_per_byte double")
