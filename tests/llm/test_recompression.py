import random

import numpy as np

from cardsentry.llm import op7_recompression as op7


def brute(rows, window):
    first, out = {}, []
    texts = [(float("inf") if i is None else i, (t or "").encode().split(), i) for i, t in rows]
    for i, w, _ in texts:
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, i), i)
    for i, w, name in texts:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        out.append((name, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["é", "the", "an", "a", "a", "a", "ß x"] + [f"t{i}" for i in range(12)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [text(rng.randrange(10, 40)) for _ in range(8)] + ["go " * 40]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            parts += [text(rng.randrange(0, 9)), rng.choice(passages)]
        t = (" ", "\t\n", "  ")[i % 3].join(parts)
        if rows and rng.random() < .2:
            t = " ".join(x for x in (rng.choice(rows)[1] or "").split() if rng.random() < .97)
        rows.append((i * 2, t))
    return rows + [(4, rows[5][1]), (4, rows[2][1]), (None, passages[0]), (None, passages[0] + " z"), (None, None), (900, ""),
                   (901, "a " * 3000), (902, passages[1] + " " + passages[1])]


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in op7.dedup(df).collect()]
        assert sorted(got, key=str) == brute(rows, 13)
    assert sum(e - s for s, e in op7.dedup(df).filter("doc_id = 902").first().spans) == \
        op7.dedup(df).filter("doc_id = 902").first().n_removed


def test_symbols_depend_on_their_context_only():
    rng = np.random.default_rng(4)
    core = rng.integers(1, 5, 60).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seen = []
    for k in (0, 3, 11):
        around = rng.integers(1, 5, 2 * k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        words = np.concatenate((around[:k], core, around[k:]))
        found = set()
        for level, (name, lo, hi) in enumerate(op7.recompress(words, np.array([0, len(words)]))):
            assert (np.diff(lo) >= 0).all() and (np.diff(hi) >= 0).all()
            found |= {(level, int(n), int(a - k), int(b - k)) for n, a, b in zip(name, lo, hi) if a >= k and b <= k + 60}
        seen.append(found)
    assert seen[0] == seen[1] == seen[2] and any(x[0] == 2 for x in seen[0])


def test_long_texts_and_empty_table(spark, monkeypatch):
    from cardsentry.llm import repeats

    monkeypatch.setattr(repeats, "SEGMENT", 50)
    rows = corpus(3, 60)
    rows.append((950, " ".join(t or "" for _, t in rows)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in op7.dedup(df).collect()]
    assert sorted(got, key=str) == brute(rows, 13)
    assert op7.dedup(df.limit(0)).collect() == []


def test_order_of_the_words_around_a_shared_passage(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        passage = " ".join(f"p{k}x{rng.randrange(10 ** 6)}" for _ in range(11))
        for i, ab in enumerate(("a b", "b a", "a c", "b d")):
            rows.append((4 * k + i, f"{ab} {passage}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in op7.dedup(df).collect()]
    assert sorted(got, key=str) == brute(rows, 13)
