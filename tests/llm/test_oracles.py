"""The queries against their DuckDB SQL on sf0.001, and the registration of all fourteen."""

import duckdb
import pytest

import __spark_entry__ as entry
from cardsentry.llm.oracles import ORACLES
from cardsentry.llm.queries import QUERIES
from conftest import SF_SMALL

TABLES = ("documents", "embeddings", "pages", "benchmark")


def test_registered():
    assert len(QUERIES) == 14 and set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert [sum(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 14)] == [1] * 13


def rounded(row):
    return tuple(round(x, 6) if isinstance(x, float) else x for x in row)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = QUERIES[key](spark, SF_SMALL)
    cur = con.execute(ORACLES[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((rounded(r) for r in cur.fetchall()), key=str)
    assert sorted((rounded(r) for r in df.select(*names).collect()), key=str) == want and want


@pytest.mark.parametrize("key", ["op1_ctw", "op2_toxicity"])
def test_whole_table(spark, key):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert QUERIES[key](spark, SF_SMALL).count() == n
