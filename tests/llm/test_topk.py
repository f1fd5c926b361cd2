import math
import random

import numpy as np
import pytest

from cardsentry.llm import op8_topk


def test_top_k_against_exhaustive(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1), 0.25]) for _ in range(9)]) for i in range(230)]
    rows += [(400 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")]), (550, [float("inf"), 1.0]), (551, []), (552, [1.0, -1.0]),
             (None, [1.0] * 9), (7, [0.5] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    single = lambda x: __import__("struct").unpack("f", __import__("struct").pack("f", x))[0]
    ok = [(i, [math.floor(256 * single(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in ok:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    got = op8_topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in op8_topk.top_k(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 1, 131072)]
    assert op8_topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_many_slots_and_strips(spark, monkeypatch):
    for name, value in (("SLOT_ROWS", 40), ("STRIP_ROWS", 15), ("TILE_QUERIES", 4), ("TILE_ROWS", 8), ("FIRST_ROWS", 6), ("MANY", 1)):
        monkeypatch.setattr(op8_topk, name, value)
    rng = random.Random(5)
    rows = [(i % 290, [float(rng.randrange(-2, 3)) for _ in range(rng.randrange(5))]) for i in range(330)]
    rows += [(7, [1.0, 1.0])] * 60 + [(i, [1.0, 1.0]) for i in range(400, 440)]  # one hot id, and ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    want = []
    for q in {i for i, _ in rows if i % 5 == 0}:
        a = min([256 * int(x) for x in v] for i, v in rows if i == q)
        scored = sorted((-sum(x * 256 * int(y) for x, y in zip(a, v)), i) for i, v in rows if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    got = op8_topk.top_k(df, df.filter("vec_id % 5 = 0"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_candidate_is_sent_once_for_a_strip_of_queries(spark):
    df = spark.range(3000).selectExpr("id AS vec_id", "transform(sequence(1, 4), i -> CAST(sin(id * i) AS float)) AS embedding")
    got = op8_topk.top_k(df, df)  # 3,000 queries; a join sent each block of candidates with each block of queries
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and got.count() == 15000


@pytest.mark.parametrize("scale, kind", [(100, np.float32), (10 ** 5, np.float64), (10 ** 8, np.int64)])
def test_winners_of_every_score_type(scale, kind):
    rng = np.random.default_rng(scale)
    m = rng.integers(-scale, scale, (12, 700))
    m[rng.random(m.shape) < 0.4] = 0
    rising = np.sort(rng.permutation(700)) // 2  # every id twice, every score above the last ones
    for query, postings in ((m[:, :50], m), (np.ones((12, 50), int), np.tile(np.arange(700) * scale // 700, (12, 1)))):
        own = np.arange(50)
        assert op8_topk.score_type(query, postings) is kind or query.max() == 1
        score, winner = op8_topk.winners(own, query, rising, postings, 5)
        for q in range(50):
            s = query[:, q] @ postings
            best = sorted((-int(x), int(i)) for x, i in zip(s, rising) if i != q)[:5]
            assert [(-int(x), int(i)) for x, i in zip(score[q], winner[q])] == best


def test_time_of_one_task():
    import time

    rng = np.random.default_rng(1)
    m = rng.integers(-150, 150, (64, 8192))

    def seconds(run):
        t = time.process_time()
        run()
        return time.process_time() - t

    def before():  # one block of 512 queries against 2,048 candidates, in 64-bit integers all the time
        scores = np.zeros((512, 2048), np.int64)
        for term in range(64):
            holders = np.flatnonzero(m[term, :512])
            scores[holders] += m[term, holders, None] * m[term, None, :2048]

    now = min(seconds(lambda: op8_topk.winners(np.arange(512), m[:, :512], np.arange(8192), m, 5)) for _ in range(3))
    assert now < 2 * min(seconds(before) for _ in range(3))  # on four times the candidates
