import random

import numpy as np
import pytest

from cardsentry.llm import op5_jaccard as op5
from cardsentry.llm.components import components


def shingles(text):
    low = bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode())
    w = low.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    big = float("inf")
    least = {}
    for x, (i, _) in zip(label, rows):
        least[x] = min(least.get(x, big), big if i is None else i)
    return sorted(((i, len(s), None if least[x] == big else least[x]) for x, s, (i, _) in zip(label, sets, rows)), key=str)


def corpus(seed, n=220):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "The"]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    passage = text(30)
    rows = []
    for i in range(n):
        if rows and rng.random() < .6:
            w = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.randrange(0, 1 + max(1, len(w) // 25))):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            w = w[rng.randrange(3):]
        else:
            w = text(rng.randrange(0, 120)) + (passage if rng.random() < .3 else [])
        rows.append((i * 3 % 1000 + i, (" ", "\n", "\t ")[i % 3].join(w if i % 2 else [x.upper() for x in w])))
    return rows + [(5, "a b c"), (9, "A  b c"), (10, "a b"), (rows[3][0], rows[8][1]), (rows[3][0], rows[3][1]), (None, rows[8][1]),
                   (None, None), (7000, ""), (7001, "x " * 20000), (7002, "x x x x x"), (None, "only here five words now"),
                   (1, " \n")]


@pytest.mark.parametrize("small", [False, True])
def test_classes_against_all_pairs(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(op5, "TILE_DOCS", 4)
        monkeypatch.setattr(op5, "FLUSH_BYTES", 500)
    rows = corpus(1 + small)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int").repartition(5)
    got = op5.classes(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    kept = op5.one_of_each(df).collect()
    classes = {c for _, n, c in brute(rows) if n}
    with_words = [r for r in kept if shingles(r.text)]
    assert len(with_words) == len({(c is None, c) for _, n, c in brute(rows) if n} | {(c,) for c in ()})
    assert {r.doc_id for r in with_words} <= classes
    assert len(kept) - len(with_words) == sum(not shingles(t) for _, t in rows)


def test_frequent_shingles_go_last(spark, monkeypatch):
    """Any order of shingles gives the same classes."""
    rows = corpus(5, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(op5, "sketch_of", lambda _: np.random.default_rng(1).integers(0, 6, 1 << op5.SKETCH_LOG2).astype(np.uint8))
    got = op5.classes(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_bands_hold_every_linkable_size():
    for s in [*range(1, 3000), 10 ** 6, 10 ** 9 + 7]:
        assert op5.band_of(s * 4 // 3) - op5.band_of(s) <= 1


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(40)] + [(500, 500), (7, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, **{200 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(spark):
    assert op5.classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_bitmaps_bound_the_symmetric_difference():
    rng = np.random.default_rng(3)
    sizes = [1, 60, 70, 90, 120, 130, 170, 900, 1100, 9000, 11000]
    base = np.unique(rng.integers(0, 1 << 62, 20000).astype(np.uint64))
    sets = [np.sort(rng.choice(base, s, replace=False)) for s in sizes]
    first = np.concatenate(([0], np.cumsum(sizes)))
    signatures = op5.Signatures(op5.bitmaps(np.concatenate(sets), first))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if 3 * max(len(a), len(b)) <= 4 * min(len(a), len(b)):
                assert signatures.apart(i, np.array([j]))[0] <= len(set(a.tolist()) ^ set(b.tolist()))
