"""The summary of heavy keys against exact counts."""

import random
from collections import Counter

from cardsentry.streaming.heavy import HeavyKeys


def test_no_heavy_key_is_lost_and_errors_are_bounded(spark, tmp_dir):
    rng, seen = random.Random(6), Counter()
    heavy = HeavyKeys(f"{tmp_dir}/h", "k", capacity=20, keep=2)
    for batch_id in range(6):
        keys = [f"hot{rng.randrange(3)}" if rng.random() < .3 else f"k{rng.randrange(500)}" for _ in range(400)] + [None] * 3
        batch = spark.createDataFrame([(k,) for k in keys], "k string")
        heavy(batch, batch_id)
        heavy(batch, batch_id)                     # a replay
        seen.update(keys)
        rows = heavy.summary(spark).collect()
        state = next(r for r in rows if r.key is None)
        total = sum(seen.values())
        assert state.rows == total and state.missed <= total / 21 and len(rows) <= 21
        for r in rows:
            if r.key is not None:
                assert r.estimate <= seen[r.key] <= r.estimate + state.missed
        for share in (.06, .08, .3):
            found = {r.k for r in heavy.candidates(spark, share).collect()}
            assert {k for k, n in seen.items() if k is not None and n >= share * total} <= found
            assert all(seen[k] >= (share - 1 / 21) * total for k in found)
    assert heavy.summary(spark, before=0) is None and HeavyKeys(f"{tmp_dir}/none", "k").candidates(spark, .1).count() == 0
