import itertools
import math
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from cardsentry.llm import op1_ctw as op1


def low(text):
    return bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode())


def brute(rows, depth):
    """Context-tree weighting by plain recursion over dictionaries."""
    counts, children = {}, {}

    def steps(b):
        s = [255] * depth + list(b) + [255]
        for i in range(depth, len(s)):
            for k in range(8):
                yield tuple(s[i - d - 1] for d in range(depth)), (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1

    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    for i, t in rows:
        if not held(i):
            for context, decision, bit in steps(low(t)):
                for d in range(depth + 1):
                    counts.setdefault((context[:d], decision), [0, 0])[bit] += 1
                    if d:
                        children.setdefault((context[:d - 1], decision), set()).add(context[:d])
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def below(context, decision):
        return sum(weighted(c, decision) for c in children.get((context, decision), ()))

    @lru_cache(None)
    def weighted(context, decision):
        own = kt(*counts.get((context, decision), (0, 0)))
        return own if len(context) == depth else np.logaddexp(own, below(context, decision)) - math.log(2)

    @lru_cache(None)
    def one(context, decision, d):
        a, b = counts.get((context[:d], decision), (0, 0))
        here = (b + .5) / (a + b + 1)
        if d == depth:
            return here
        stop = 1 / (1 + math.exp(min(700, max(-700, below(context[:d], decision) - kt(a, b)))))
        return stop * here + (1 - stop) * one(context, decision, d + 1)

    words = {}
    n_train = sum(len(low(t).split()) + 1 for i, t in rows if not held(i))
    for i, t in rows:
        if not held(i):
            for w in itertools.chain(low(t).split(), [None]):
                words[w] = words.get(w, 0) + 1
    out = []
    for i, t in rows:
        tokens = [*low(t).split(), None]
        base = sum(math.log10((words.get(w, 0) + .5) / (n_train + .5 * (len(words) + 1))) for w in tokens)
        p = sum(math.log10(one(c, d, 0) if bit else 1 - one(c, d, 0)) for c, d, bit in steps(low(t)))
        out.append((i, held(i), len(tokens), sum(w in words for w in tokens), n_train, base, p))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[6], 2))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-6) and g[6] == pytest.approx(w[6], rel=1e-4, abs=1e-3)


@pytest.mark.parametrize("depth", [2, 5])
def test_against_recursion(spark, depth):
    rng = random.Random(depth)
    words = ["The", "cat", "é", "sat", "mat", "on", "xyz"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    rows += [(None, "the cat"), (3, "again the"), (50, None), (51, ""), (52, "z" * 300 + "\tQ\n")]
    got = op1.score(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int"), depth)
    same([r[:7] for r in got.collect()], brute(rows, depth))


def test_long_text_in_pieces_and_better_than_base(spark, monkeypatch):
    monkeypatch.setattr(op1, "CHUNK", 64)
    rng = random.Random(9)
    words = ["the", "cat", "sat", "on", "a", "mat"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(60)]
    got = op1.score(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    same([r[:7] for r in got], brute(rows, 3))
    assert all(0 < r.bits_per_byte < 3 for r in got)


def test_without_training_texts_and_rows(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    df = spark.createDataFrame([(i, "abc") for i in ids], "doc_id long, text string")
    for r in op1.score(df).collect():
        assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 2)
        assert r.score == pytest.approx(32 * math.log10(0.5), rel=1e-5)
    assert op1.score(df.limit(0)).collect() == []
