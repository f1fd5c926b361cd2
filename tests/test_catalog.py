"""Every catalog query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from cardsentry.plans.catalog import QUERIES  # noqa: E402
from cardsentry.plans.oracle import oracles  # noqa: E402
from check_oracles import TABLES, digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

KEYS = sorted(QUERIES)


def test_keys_have_oracles():
    assert set(oracles()) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[key])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "alert_id" in df.columns
