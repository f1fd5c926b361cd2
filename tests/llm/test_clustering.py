import hashlib
import math
import random

import numpy as np
import pytest

from cardsentry.llm import op13_clustering as op13


def brute(rows, size, k=8, rounds=10, scale=1024):
    """Lloyd's rounds in plain Python integers."""
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    code = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [x for _, x in sorted(kept, key=code)[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    assign = lambda: [min(range(len(centres)), key=lambda c: (far(x, centres[c]), c)) for _, x in kept]
    for _ in range(rounds):
        label = assign()
        for c in range(len(centres)):
            own = [x for (_, x), at in zip(kept, label) if at == c]
            if own:
                centres[c] = [sum(col) // len(own) for col in zip(*own)]
    label = assign()
    d = [far(x, centres[c]) for (_, x), c in zip(kept, label)]
    inertia = [sum(v for v, c in zip(d, label) if c == at) for at in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, v, inertia[c], sum(d), sha[c]) for (i, _), c, v in zip(kept, label, d)), key=str)


def result(df, **options):
    return sorted(((r.vec_id, r.cluster, int(r.distance), int(r.cluster_inertia), int(r.inertia), r.centroid_sha256)
                   for r in op13.cluster(df, **options).collect()), key=str)


@pytest.mark.parametrize("size,block", [(6, 7), (64, 4096)])
def test_against_plain_python(spark, monkeypatch, size, block):
    monkeypatch.setattr(op13, "BLOCK_ROWS", block)
    rng = random.Random(size)
    centres = [[rng.uniform(-1, 1) for _ in range(size)] for _ in range(11)]
    rows = [(i, [c + rng.gauss(0, .2) for c in rng.choice(centres)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # copies
    rows += [(2000 + i, [float(rng.randrange(-1, 2)) for _ in range(size)]) for i in range(60)]  # ties
    rows += [(None, rows[3][1]), (5, rows[8][1]), (5, rows[8][1]), (3000, None), (3001, [1.0] * (size - 1)),
             (3002, [None] * size), (3003, [float("nan")] * size), (3004, [float("inf")] * size)]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, x int").repartition(3)
    assert result(df, size=size) == brute(rows, size)


def test_equal_starts_few_vectors_and_huge_components(spark):
    schema = "vec_id long, embedding array<double>"
    same = [(i, [0.5, 0.25]) for i in range(20)]
    assert result(spark.createDataFrame(same, schema), size=2) == brute(same, 2)
    few = [(1, [0.0, 1.0]), (2, [3.0, 1.0]), (None, [9.0, 9.0])]
    assert result(spark.createDataFrame(few, schema), size=2) == brute(few, 2)
    wide = [(i, [float(i % 5) * 2.0 ** 33, float(-i)]) for i in range(90)]
    assert result(spark.createDataFrame(wide, schema), size=2) == brute(wide, 2)
    assert op13.cluster(spark.createDataFrame([(1, None)], schema)).collect() == []


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(7)
    for scale, flat in ((1000, False), (3, False), (1 << 24, True)):
        pivots = rng.integers(-scale, scale, (16, 24))
        if flat:
            pivots[1:] = pivots[0] + rng.integers(-2, 3, (15, 24))  # a narrow base far from everything
            pivots[5] = pivots[4]
        x = np.vstack((rng.integers(-scale, scale, (200, 24)), pivots))
        simplex = op13.Simplex(pivots)
        centres = np.vstack((pivots[:4], rng.integers(-scale, scale, (4, 24))))
        lower, upper = op13.bounds(simplex.apex(x), simplex.apex(centres))
        for c, centre in enumerate(centres):
            true = np.sqrt(op13.squared(x, centre).astype(float))
            assert (lower[:, c] <= true * (1 + 1e-15)).all() and (true <= upper[:, c] * (1 + 1e-15)).all()
    # clustered vectors: most centroids are ruled out without an exact comparison
    centres = rng.integers(-1000, 1000, (8, 24))
    x = centres[rng.integers(0, 8, 2000)] + rng.integers(-50, 50, (2000, 24))
    simplex = op13.Simplex(np.vstack((x[:16],)))
    label, d, compared = op13.nearest(x, simplex.apex(x), list(centres), simplex.apex(centres))
    exact = np.array([op13.squared(x, c) for c in centres])
    assert (label == exact.argmin(axis=0)).all() and (d == exact.min(axis=0)).all() and compared < 3 * len(x)
