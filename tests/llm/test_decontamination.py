import hashlib
import random
import re

from cardsentry.llm import op9_decontamination as op9

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        size = min(13, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[a:a + size]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for a in range(len(w) - size + 1):
                key = tuple(w[a:a + size])
                if key in windows:
                    hit |= set(range(a, a + size))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_report_against_brute_force(spark):
    rng = random.Random(7)
    vocab = ["a", "B", "cé", "d1", "e", "Ünder", "the", "of"] + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randrange(0, 40))) for i in range(25)] + [(3, text(20)), (None, text(14)), (99, None), (98, "... !!"),
                                                                    (97, "w1 w2 w3"), (96, "zzz")]
    docs = []
    for i in range(120):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1)
            parts += [", ".join(w[a:a + rng.randrange(10, 30)]), text(rng.randrange(0, 60))]
        docs.append((i, "-".join(parts).upper() if i % 5 == 0 else " ".join(parts)))
    docs += [(5, "again zzz"), (None, None), (200, ""), (201, "q " * 3000 + items[0][1] + " zzz"), (202, items[1][1])]
    got = op9.report(spark.createDataFrame(docs, "doc_id long, text string"),
                     spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert op9.report(docs.limit(0), items).collect() == []
    assert [tuple(r)[:4] for r in op9.report(docs, items.limit(0)).collect()] == [(1, 3, 0, 0)]
