import math
import random
from fractions import Fraction

import numpy as np
import pytest

from cardsentry.llm import op11_whitening as op11


def single(x):
    return float(np.float32(x))


def brute(rows, k=4):
    """Whitening by plain Python integers and a textbook eigen decomposition."""
    kept = [(i, [math.floor(256 * single(c)) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), max(len(x) for _, x in kept)
    pad = lambda x: list(x) + [0] * (d - len(x))
    total = [sum(pad(x)[j] for x in fit) for j in range(d)]
    cov = np.array([[float(Fraction(sum((n * pad(x)[i] - total[i]) * (n * pad(x)[j] - total[j]) for x in fit), n ** 3))
                     for j in range(d)] for i in range(d)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = []
    for i, x in kept:
        centred = np.array([a - t / n for a, t in zip(pad(x), total)])
        out.append((i, n, sum((n * a - t) ** 2 for a, t in zip(pad(x), total)), centred @ v / np.sqrt(e), e / np.trace(cov)))
    return sorted(out, key=str), n


@pytest.mark.parametrize("block", [64, 8192])
def test_against_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(op11, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 7)) @ np.diag([5, 3, 2, 1, .5, .3, .2])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(50)]  # copies count once
    rows += [(None, rows[9][1]), (3, rows[11][1]), (2000, [1.0, 2.0]), (2001, None), (2002, [1.0, None]),
             (2003, [float("nan")]), (2004, [float("-inf"), 1.0]), (2005, [-0.0] * 7), (2006, [])]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<float>, x int, id double").repartition(3)
    got = op11.whiten(df).collect()
    want, n = brute(rows)
    assert len(got) == 4 * len(want)
    by_row = {}
    for r in got:
        by_row.setdefault((str(r.vec_id), int(r.deviation)), []).append(r)
    sign = None
    for i, m, deviation, w, explained in want:
        own = sorted(by_row[str(i), deviation], key=lambda r: r.component)[:4 * 1]
        own = [next(r for r in by_row[str(i), deviation] if r.component == c) for c in range(1, 5)]
        values = np.array([r.whitened for r in own])
        sign = np.sign(values * w) if sign is None else sign
        assert np.allclose(values, sign * w, rtol=1e-7, atol=1e-9)
        assert np.allclose([r.explained for r in own], explained, rtol=1e-9) and {r.n for r in own} == {n == m and n}
    assert max(r.identity_error for r in got) < 1e-9


def test_bit_sliced_products_are_exact():
    rng = random.Random(2)
    for reach in (1, 300, 1 << 40, (1 << 63) - 1):
        x = np.array([[rng.randint(-reach, reach) for _ in range(5)] for _ in range(131)], np.int64)
        x[:, 3] = 7
        total, q = op11.scatter(x)
        exact = x.astype(object)
        assert list(total) == list(exact.sum(axis=0))
        assert (q == np.triu(exact.T @ exact)).all()


def test_huge_components_and_no_variance(spark):
    rows = [(1, [1e30, 0.5, 1.0]), (2, [-1e30, 0.25, 1.0]), (3, [0.0, 8.0, 1.0])]
    got = op11.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 9 and [r.whitened is None for r in sorted(got, key=lambda r: (r.vec_id, r.component))] == [False, True, True] * 3
    one = op11.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 2, "vec_id long, embedding array<double>")).collect()
    assert len(one) == 4 and all(r.n == 1 and r.whitened is None and r.explained is None and r.identity_error is None
                                 and r.deviation == 0 for r in one)


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [float("nan")])], [(1, [])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert op11.whiten(df).collect() == []
