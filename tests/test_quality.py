from pyspark.sql import Observation

from cardsentry.operators.quality import (apply_expectations, expect, expect_or_drop,
                                          expectation_report)

RULES = [expect_or_drop("valid_id", "id IS NOT NULL"), expect("valid_amount", "amount > 0")]


def rows(spark):
    return spark.createDataFrame([(1, 5.0), (None, 1.0), (2, None), (3, -1.0)], "id int, amount double")


def test_drop_and_warn(spark):
    obs = Observation("q")
    kept = apply_expectations(rows(spark), RULES, obs)
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3]     # Q1 drops one row
    m = obs.get
    assert m["input_records"] == 4
    assert m["valid_id"] == 1
    assert m["valid_amount"] == 2                                # NULL counts as failed


def test_report(spark):
    got = {r.expectation: (r.action, r.passed_records, r.failed_records)
           for r in expectation_report(rows(spark), RULES).collect()}
    assert got == {"valid_id": ("drop", 3, 1), "valid_amount": ("warn", 2, 2)}
