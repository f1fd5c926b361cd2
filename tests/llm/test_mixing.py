import math

import pytest

from cardsentry.llm import op3_mixing


def water_fill(sizes, weights, cap=3):
    """Reference: clamp, reshare the excess by weight, repeat."""
    total, stopped = sum(sizes.values()), {}
    while True:
        left = total - sum(stopped.values())
        free = {s: w for s, w in weights.items() if s not in stopped}
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**stopped, **share}
        for s in over:
            stopped[s] = cap * sizes[s]


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(60):
        source = [None, "a", "b", "z", "é"][min(i % 9, 4)]
        out.append((i, source, " ".join(["w"] * (i * 7 % 31)) if i % 11 else None, "x"))
    out += [(3, "a", "one two  three four\n\tfive", "y"), (3, "a", "one two", "y"), (None, "b", "", "z"),
            (100, "huge", "word " * 20000, "z"), (101, "empty", "", "z")]
    return out


def test_mix_matches_iterated_water_filling(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size string")
    got = op3_mixing.mix(df).collect()
    assert len(got) == len(rows)
    count = lambda t: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w])
    sizes = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + count(t)
    order = sorted(sizes, key=lambda s: (s is None, s))
    goal = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert t == math.floor(goal[s] + 1e-6) or abs(t - goal[s]) <= 1
    again = op3_mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty_and_all_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert op3_mixing.mix(df).collect() == []
    df = spark.createDataFrame([(1, None, None), (2, "a", "")], "doc_id long, source string, text string")
    assert [(r["size"], r.target, r.taken) for r in op3_mixing.mix(df).collect()] == [(0, 0.0, 0)] * 2
