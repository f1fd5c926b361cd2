import random

import numpy as np

from cardsentry.llm import op12_minhash as op12


def shingles(text):
    low = bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode())
    w = low.split()
    return {tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) >= 2 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and label[i] != label[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for x, (i, _) in zip(label, rows):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted(((i, len(s), least.get(x), i == least.get(x)) for x, s, (i, _) in zip(label, sets, rows)), key=str)


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "The"]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    passage = text(30)
    rows = []
    for i in range(n):
        if rows and rng.random() < .6:
            w = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.randrange(0, 1 + max(1, len(w) // 15))):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            w = w[rng.randrange(3):]
        else:
            w = text(rng.randrange(0, 120)) + (passage if rng.random() < .3 else [])
        rows.append((i * 3 % 1000 + i, (" ", "\n", "\t ")[i % 3].join(w if i % 2 else [x.upper() for x in w])))
    return rows + [(5, "a"), (9, "A "), (10, "a b"), (11, "a b c d e"), (12, "a b c d e f"), (rows[3][0], rows[8][1]),
                   (rows[3][0], rows[3][1]), (None, rows[8][1]), (None, None), (7000, ""), (7001, "x " * 20000), (7002, "x x x"),
                   (None, "only here five words now"), (1, " \n")]


def test_classes_against_all_pairs(spark, monkeypatch):
    """Groups larger than a tile, lists spread over buckets; the SQL test runs with the settings as they are."""
    monkeypatch.setattr(op12, "TILE", 4)
    monkeypatch.setattr(op12, "FEW_TILES", 3)
    monkeypatch.setattr(op12, "FLUSH_NODES", 10)
    monkeypatch.setattr(op12, "SPLIT_LOG2", 3)
    rows = corpus(2)
    names = "doc_id long, text string, node int, sig string, n int, print int, g int, root int, least string"
    df = spark.createDataFrame([(*r, 1, "s", 2, 3, 4, 5, "l") for r in rows], names).repartition(5)
    got = op12.classes(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, bool(r.kept and r.doc_id is not None)) for r in got), key=str) == \
        [(*r[:3], r[3] and r[0] is not None) for r in brute(rows)]
    assert all(r.kept == (r.component_id is None) for r in got if r.doc_id is None)


def test_any_order_of_keys_gives_the_same_classes(spark, monkeypatch):
    rows = corpus(5, 130)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(op12, "frequencies", lambda _: np.random.default_rng(1).integers(0, 6, 1 << op12.SKETCH_LOG2).astype(np.uint8))
    got = op12.classes(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted((r[:3] for r in brute(rows)), key=str)


def test_empty_table(spark):
    assert op12.classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert [tuple(r) for r in op12.classes(spark.createDataFrame([(4, None)], "doc_id long, text string")).collect()] == [(4, 0, 4, True)]


def test_coordinates_agree_as_often_as_sets():
    """Agreements of two sets follow the binomial law of their similarity: mean, spread, and no pair below the threshold."""
    rng = np.random.default_rng(11)
    counts = []
    for size in (5, 45, 900):
        union = rng.integers(0, 1 << 63, (3000, size)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        common = union[:, :size * 8 // 10]
        pairs = []
        for half in (0, 1):
            rest = union[:, size * 8 // 10:]
            own = np.concatenate((common, rest[:, half::2]), axis=1)
            pairs.append(op12.signatures(own.ravel(), np.arange(0, own.size + 1, own.shape[1])))
        counts.append((pairs[0] == pairs[1]).sum(axis=1))
    for c in counts:
        assert abs(c.mean() - .8 * op12.COORDINATES) < .5 and c.std() < 4 and c.min() >= op12.MATCHES


def test_many_near_copies_make_no_pairs(spark, monkeypatch):
    """Distinct near copies of one text, far more than a tile: edges stay in proportion to the copies."""
    monkeypatch.setattr(op12, "TILE", 50)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(600):
        w = list(base)
        w[rng.randrange(400)] = f"u{i}"
        rows.append((i if i % 3 else None, " ".join(w)))
    rows += [(10_000 + i, " ".join(f"z{rng.randrange(900)}" for _ in range(60))) for i in range(60)]
    made = []
    pairs = op12.compared
    monkeypatch.setattr(op12, "compared", lambda *a: made.append(pairs(*a)) or made[-1])
    got = op12.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert all(r.component_id == 1 for r in got if r.doc_id is None or r.doc_id < 10_000)
    assert all(r.component_id == r.doc_id for r in got if r.doc_id is not None and r.doc_id >= 10_000)
    assert sum(df.count() for df in made) < 60 * 600
