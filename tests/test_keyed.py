"""Keyed state with timers: pairs of the bounded join, late entries, expiry."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cardsentry.schemas import TRANSACTION_PAYLOAD
from cardsentry.streaming.keyed import keyed_matches
from cardsentry.streaming.sinks import finish, stream_to_path
from test_streams import WL_SCHEMA, t, tx_row, wl_row

DROPS = [
    # entry first, transaction first, no card, no time, one minute past the lag, and before the entry
    ([("T1", "c1", t(10, 0)), ("T0", "C2", t(9, 55)), ("N1", None, t(10, 0)), ("N2", "C1", None), ("T9", "C1", t(10, 31)),
      ("T8", "C1", t(9, 29))], [("W1", "C1", t(9, 30)), ("N", None, t(9, 30)), ("M", "C1", None)]),
    # behind the newest rows of its side, by less than the lag: still matched, with a transaction of the drop before
    ([("T2", "C1", t(10, 30))], [("W2", "C2", t(9, 0)), ("W3", "C8", t(9, 50))]),
    ([("T3", "C9", t(14, 0))], [("W4", "C9", t(14, 0))]),
    # the periods of the morning are closed: nothing is left of T0 and W1
    ([("T4", "C9", t(14, 5)), ("T5", "C1", t(10, 5))], [("W5", "C2", t(9, 0))]),
]
PAIRS = [("T0", "W2"), ("T1", "W1"), ("T2", "W1"), ("T3", "W4"), ("T4", "W4")]


def state_rows(spark, checkpoint, name):
    return (spark.read.format("statestore").option("stateVarName", name).load(checkpoint).selectExpr("key._card AS card").collect())


@pytest.mark.parametrize("salt", [1, 3])
def test_pairs_and_expiry(spark, tmp_dir, salt):
    left = []
    for i, (txs, wls) in enumerate(DROPS):
        spark.createDataFrame([tx_row(*r) for r in txs], TRANSACTION_PAYLOAD).write.parquet(f"{tmp_dir}/tx/step={i}")
        spark.createDataFrame([wl_row(*r) for r in wls], WL_SCHEMA).write.parquet(f"{tmp_dir}/wl/step={i}")
        tx = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/tx")
        wl = spark.readStream.schema(WL_SCHEMA).parquet(f"{tmp_dir}/wl")
        finish(stream_to_path(keyed_matches(tx, wl, timedelta(hours=1), salt), f"{tmp_dir}/out", f"{tmp_dir}/ck"))
        left.append(sorted(r.card for r in state_rows(spark, f"{tmp_dir}/ck", "transactions")))
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted((r.transaction_id, r.watchlist_id) for r in got.collect()) == PAIRS
    one = got.where("transaction_id = 'T1'").first()
    assert (one.card_number, one.amount, one.transaction_timestamp, one.effective_from) == ("c1", 1.0, t(10, 0), t(9, 30))
    assert len(left[0]) == 4 and len(left[1]) == 5      # rows without card or time are no state
    assert set(left[2]) == set(left[3]) == {"C9"}       # the morning's state is gone


def test_rows_travel_as_one_text(spark, tmp_dir):
    card, at = 'c"1\\é', t(10, 0).replace(microsecond=123457)
    spark.createDataFrame([tx_row("T1", card, at)], TRANSACTION_PAYLOAD).withColumn("amount", F.lit(float("nan"))) \
        .withColumn("currency", F.lit("")).withColumn("city", F.lit(None).cast("string")).write.parquet(f"{tmp_dir}/tx")
    spark.createDataFrame([wl_row("W1", card.upper(), t(9, 30))], WL_SCHEMA).write.parquet(f"{tmp_dir}/wl")
    tx = spark.readStream.schema(TRANSACTION_PAYLOAD).parquet(f"{tmp_dir}/tx")
    wl = spark.readStream.schema(WL_SCHEMA).parquet(f"{tmp_dir}/wl")
    finish(stream_to_path(keyed_matches(tx, wl, timedelta(hours=1)), f"{tmp_dir}/out", f"{tmp_dir}/ck"))
    got = spark.read.parquet(f"{tmp_dir}/out").first()
    assert (got.card_number, got.transaction_timestamp, got.currency, got.watchlist_id) == (card, at, "", "W1")
    assert got.amount != got.amount
    state = spark.read.format("statestore").option("stateVarName", "transactions").load(f"{tmp_dir}/ck")
    assert state.selectExpr("list_element.*").columns == ["at", "row"]
