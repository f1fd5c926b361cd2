import random

from cardsentry.llm import op4_suffixes as op4


def brute(rows, length):
    seen, out = {}, []
    texts = [(float("inf") if i is None else i, (t or "").encode(), i) for i, t in rows]
    texts.sort(key=lambda x: (x[0], x[1]))
    for _, b, i in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen[s] = True
        spans, p = [], 0
        while p < len(b):
            if gone[p]:
                q = p
                while q < len(b) and gone[q]:
                    q += 1
                spans.append((p, q))
                p = q
            else:
                p += 1
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["é", "the", "an", "orange", "bin", "x", "ß"] + [f"t{i}" for i in range(40)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [text(rng.randrange(20, 60)) for _ in range(6)] + ["line of some 70 bytes that is repeated in many documents, again, ok"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += [text(rng.randrange(0, 12)), p if rng.random() < .5 else p[a:]]
        t = " ".join(parts)
        if rows and rng.random() < .2:
            t = list(rng.choice(rows)[1] or "")
            for _ in range(rng.randrange(3)):
                if t:
                    t[rng.randrange(len(t))] = "#"
            t = "".join(t)
        rows.append((i * 3, t))
    return rows + [(3, rows[5][1]), (3, "zz"), (None, passages[0]), (None, None), (700, ""), (701, "a" * 5000), (702, "ab" * 400),
                   (703, passages[1] + passages[1])]


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
        got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in op4.dedup(df).collect()]
        assert sorted(got, key=str) == brute(rows, 100)


def test_long_texts_in_pieces(spark, monkeypatch):
    from cardsentry.llm import repeats

    monkeypatch.setattr(repeats, "SEGMENT", 300)
    rows = corpus(3, 60)
    rows.append((900, " ".join(t or "" for _, t in rows)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in op4.dedup(df).collect()]
    assert sorted(got, key=str) == brute(rows, 100)


def test_empty_table(spark):
    assert op4.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_order_of_the_bytes_around_a_shared_passage(spark):
    rng = random.Random(8)
    rows, a, b, c, d = [], "aAaaAaAA", "bBbBBbbB", "cCCCcCcc", "dDddDDdD"
    for k in range(40):
        passage = "".join(rng.choice("efghijklmnopqrstuvwxyz ") for _ in range(84))
        for i, ab in enumerate((a + b, b + a, a + c, b + d)):
            rows.append((4 * k + i, ab + passage))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in op4.dedup(df).collect()]
    assert sorted(got, key=str) == brute(rows, 100)
