"""Substring dedup by recompression of word sequences.

Rounds rename the words of every text: a round first names each maximal run of
one symbol, then each pair of neighbours whose left symbol falls in one half of
the alphabet and whose right symbol falls in the other.  A name is a fingerprint
of what it stands for, so all tasks give equal substrings equal symbols in their
interior without meeting; near the ends the neighbours decide.  For every symbol
the words that decide it are known (its context).  A window's anchor is a symbol
of the highest round whose context lies in the window, so every occurrence of
the window has it.  Spark counts the anchors of all texts; shared ones reveal
candidates, and the words themselves are compared to verify repeats of a whole
window (``repeats``).

A word is removed if it lies in a window that also starts in a row with a smaller
id.  Windows are judged on the input.

Defined cases: null text has no words; rows that repeat an id do not remove each
other's words; rows without an id come after all others; a text shorter than a
window keeps everything; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import constants, mix, word_bounds, word_hashes
from .repeats import Prints, Windows, id_of, repeated_ranges, window_starts

WINDOW = 13
ROUNDS = 2
_RUN, _PAIR, _ANCHOR = constants(2, 31), constants(2, 32), constants(2, 33)
_PLACE = np.uint64(30)


def runs(symbol, start, lo, hi, text):
    """Name maximal runs of a symbol; a symbol's neighbours show that its run ends."""
    n = len(symbol)
    new = np.ones(n, bool)
    new[1:] = (symbol[1:] != symbol[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], n) - 1
    size = end - at + 1
    named = np.where(size > 1, mix(symbol[at] * _RUN[0] + size.astype(np.uint64) * _RUN[1]), symbol[at])
    return named, start[at], *_widened(lo, hi, at, end), text[at]


def _widened(lo, hi, at, end):
    """Context of items made of symbols ``at`` to ``end``, with the symbols beside them."""
    n = len(lo)
    left, right = np.maximum(at - 1, 0), np.minimum(end + 1, n - 1)
    return np.where(at > 0, lo[left], lo[at] - 1), np.where(end < n - 1, hi[right], hi[end] + 1)


def pairs(symbol, start, lo, hi, text):
    """Name neighbours with a left symbol of one half and a right symbol of the other."""
    n = len(symbol)
    half = mix(symbol * _PAIR[0]) >> np.uint64(63) == 0  # True: may stand left in a pair
    joined = np.zeros(n, bool)  # a pair begins here
    joined[:-1] = half[:-1] & ~half[1:] & (text[1:] == text[:-1])
    second = np.zeros(n, bool)
    second[1:] = joined[:-1]
    at = np.flatnonzero(~second)
    pair = joined[at]
    mate = np.minimum(at + 1, n - 1)
    named = np.where(pair, mix(symbol[at] * _PAIR[0] + symbol[mate] * _PAIR[1]), symbol[at])
    # a single symbol is one because of the neighbour on the side where it could pair
    lo_wide, hi_wide = _widened(lo, hi, at, at)
    lone_left, lone_right = ~pair & half[at], ~pair & ~half[at]
    return (named, start[at], np.where(lone_right, lo_wide, lo[at]),
            np.where(pair, hi[mate], np.where(lone_left, hi_wide, hi[at])), text[at])


def recompress(words: np.ndarray, first: np.ndarray, rounds: int = ROUNDS):
    """Per round (0: the words) the symbols and their contexts ``(name, lo, hi)``.

    At the ends of a text a context reaches past the text, so no window holds it.
    """
    place = np.arange(len(words))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    state = (words, place, place, place + 1, text)
    out = [(state[0], state[2], state[3])]
    for _ in range(rounds):
        state = pairs(*_outside(runs(*_outside(state, first)), first))
        state = _outside(state, first)
        out.append((state[0], state[2], state[3]))
    return out


def _outside(state, first):
    """Contexts that reached over a text's end into the next text end just past their own."""
    symbol, start, lo, hi, text = state
    return symbol, start, np.maximum(lo, first[text] - 1), np.minimum(hi, first[text + 1] + 1), text


def anchors(length: int, rounds: int = ROUNDS):
    def find(words: np.ndarray, first: np.ndarray):
        """Window starts with the place, size and key of their anchors: of the symbols
        whose context lies in the window the highest round's with the least hash."""
        p = window_starts(first, length)
        if not len(p):
            return p, p, p, p.astype(np.uint64)
        prints = Prints(words)
        at = np.full(len(p), -1)
        size = np.zeros(len(p), np.int64)
        key = np.zeros(len(p), np.uint64)
        for level, (name, lo, hi) in reversed(list(enumerate(recompress(words, first, rounds)))):
            open_ = np.flatnonzero(at < 0)
            if not len(open_):
                break
            i = np.searchsorted(lo, p[open_])
            j = np.searchsorted(hi, p[open_] + length, "right")
            some = j > i
            open_, i, j = open_[some], i[some], j[some]
            order = (mix(name * _ANCHOR[0]) >> _PLACE << _PLACE) | np.arange(len(name), dtype=np.uint64)
            best = _range_min(order, i, j)
            at[open_] = lo[best]
            size[open_] = (hi - lo)[best]
            key[open_] = prints(lo[best], hi[best]) + np.uint64(level) * _ANCHOR[1]
        return p, at, size, key
    return find


def _range_min(order: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Place of the least value of every range ``[i, j)``."""
    least = np.full(len(i), np.iinfo(np.uint64).max, np.uint64)
    width, table = 1, order
    while True:
        here = (j - i >= width) & (j - i < 2 * width)
        if here.any():
            least[here] = np.minimum(table[i[here]], table[j[here] - width])
        if len(table) <= width or not (j - i >= 2 * width).any():
            return (least & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
        table, width = np.minimum(table[:-width], table[width:]), 2 * width


def _words(offsets: np.ndarray, data: np.ndarray):
    hashes, firsts, total = [], [np.zeros(1, np.int64)], 0
    from .common import chunk_rows

    for i, j in chunk_rows(offsets):
        local, part = offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]]
        starts, ends, first = word_bounds(local, part, "spaced")
        hashes.append(word_hashes(part, starts, ends))
        firsts.append(first[1:] + total)
        total += len(starts)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


def dedup(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept)`` per row.

    ``spans`` are the maximal removed runs of words ``(start, end)``, ``kept`` the
    remaining words joined by one space.
    """
    if not 4 <= window <= 255:
        raise ValueError("window must be from 4 to 255 words")

    def finish(ids, offsets, data, first, covered):
        n = np.diff(first)
        removed = np.diff(np.concatenate(([0], np.cumsum(covered)))[first])
        kept, spans = [], []
        for k in range(len(ids)):
            words = data[offsets[k]:offsets[k + 1]].tobytes().split()
            gone = covered[first[k]:first[k + 1]]
            if removed[k]:
                words = itertools.compress(words, ~gone)
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                spans.append([{"start": int(a), "end": int(b)} for a, b in edge])
            else:
                spans.append([])
            kept.append(b" ".join(words))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": id_of(ids), "n_words": pa.array(n.astype(np.int64)),
                         "n_removed": pa.array(removed.astype(np.int64)), "spans": pa.array(spans, kind),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    w = Windows(window, _words, anchors(window, rounds), False, "uint64")
    return repeated_ranges(w, docs, finish, "doc_id long, n_words long, n_removed long, "
                                            "spans array<struct<start:bigint,end:bigint>>, kept string")
