"""Named data-quality expectations.

``expect`` keeps failing rows and only counts them; ``expect_or_drop`` also
removes them.  A predicate that evaluates to NULL counts as failed.  All
expectations are evaluated on the same input rows; the drops are applied after
every rule has been counted.  Counting uses ``DataFrame.observe``: the counts
are gathered while the rows flow (no second pass, works on streams, where they
appear in ``StreamingQueryProgress.observedMetrics``).  The observation also
keeps the optimizer from copying the expressions the predicates read (the
JSON parse of silver) into a pushed-down filter, which would evaluate them
twice per row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

ROWS_METRIC = "input_records"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"          # "warn" or "drop"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "warn")


def expect_or_drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "drop")


def failure_counts(expectations: list[Expectation]) -> list[Column]:
    return ([F.count(F.lit(1)).alias(ROWS_METRIC)]
            + [F.count_if(~e.passed()).alias(e.name) for e in expectations])


def apply_expectations(df: DataFrame, expectations: list[Expectation],
                       observation: str | Observation | None = None) -> DataFrame:
    """Count failures per expectation and drop the rows that fail a ``drop``
    expectation.  ``observation``: name (or ``Observation``) under which the
    counts are reported; a private name when not given."""
    if not expectations:
        return df
    if observation is None:
        observation = f"expectations_{uuid.uuid4().hex[:12]}"
    df = df.observe(observation, *failure_counts(expectations))
    drops = [e.passed() for e in expectations if e.action == "drop"]
    if not drops:
        return df
    return df.where(reduce(lambda a, b: a & b, drops))


def expectation_report(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """One row per expectation: ``expectation, action, passed_records,
    failed_records`` (one distributed aggregation over ``df``)."""
    totals = df.agg(*failure_counts(expectations))
    rows = [F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                     F.col(e.name).alias("failed_records")) for e in expectations]
    return (totals.select(F.col(ROWS_METRIC), F.explode(F.array(*rows)).alias("r"))
            .select("r.expectation", "r.action",
                    (F.col(ROWS_METRIC) - F.col("r.failed_records")).alias("passed_records"),
                    "r.failed_records"))


def metrics_report(metrics: dict, expectations: list[Expectation]) -> list[tuple]:
    """Rows of the report from observed metrics (a dict of name -> count)."""
    total = int(metrics.get(ROWS_METRIC, 0))
    return [(e.name, e.action, total - int(metrics.get(e.name, 0)), int(metrics.get(e.name, 0)))
            for e in expectations]
