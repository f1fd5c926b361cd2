import datetime as dt

from pyspark.sql import functions as F, types as T

from cardsentry.functions import (full_name, html_escape, id_number, mask_card, parse_json,
                                  parse_timestamp, rescued_data, risk_color)
from cardsentry.schemas import TRANSACTION_PAYLOAD, WATCHLIST_TIME_FORMAT

SMALL = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def test_from_json_outcomes(spark):
    rows = [
        ('{"transaction_id":"t1","amount":5.5}',),
        ('{"transaction_id":"t2","amount":"abc"}',),
        ('{"transaction_id":"t3"',),
        ("{}",),
        ("null",),
        (None,),
        ('[{"transaction_id":"t4"}]',),
        ('{"transaction_id":7}',),
        ('{"transaction_id":"t5","transaction_timestamp":"not a time"}',),
    ]
    df = spark.createDataFrame(rows, "value string")
    out = df.select(parse_json("value", TRANSACTION_PAYLOAD).alias("d")).collect()
    got = [(r.d.transaction_id, r.d.amount) if r.d is not None else None for r in out]
    assert got[0] == ("t1", 5.5)
    assert got[1] == ("t2", None)          # mistyped field -> NULL, others kept
    assert got[2] == (None, None)          # malformed -> all NULL
    assert got[3] == (None, None)
    assert got[4] == (None, None)
    assert got[5] is None                  # NULL input -> NULL struct
    assert got[7] == ("7", None)           # number into a string field -> its text
    assert got[8][0] == "t5"


def test_rescued_data(spark):
    rows = [('{"id":"w1","n":1}',), ('{"id":"w2","n":"abc"}',), ('{"id":"w3","extra":"z"}',),
            ('{bad',), (None,)]
    df = spark.createDataFrame(rows, "value string")
    got = [r[0] for r in df.select(rescued_data("value", SMALL)).collect()]
    assert got == [None, '{"n":"abc"}', '{"extra":"z"}', "{bad", None]


def test_watchlist_dates(spark):
    rows = [("05-Mar-2024 10:11:12",), ("05-MAR-2024 10:11:12",), ("2024-03-05T10:11:12",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(parse_timestamp("s", WATCHLIST_TIME_FORMAT)).collect()]
    assert got[0] == dt.datetime(2024, 3, 5, 10, 11, 12)
    assert got[1] == dt.datetime(2024, 3, 5, 10, 11, 12)
    assert got[2] is None and got[3] is None   # no failure, NULL instead


def test_names_colors_masks(spark):
    df = spark.createDataFrame(
        [("Ann", "Lee", "HIGH", "4000000000001234", 'a<b&"c">'), (None, None, None, None, None),
         ("Bo", None, "weird", "12", "x")],
        "f string, l string, r string, c string, h string")
    got = df.select(full_name("f", "l"), risk_color("r"), mask_card("c"), html_escape("h")).collect()
    assert got[0] == ("Ann Lee", "#fd7e14", "**** 1234", "a&lt;b&amp;&quot;c&quot;&gt;")
    assert got[1] == ("", "#6c757d", None, None)
    assert got[2][0] == "Bo" and got[2][1] == "#6c757d"


def test_id_number(spark):
    df = spark.createDataFrame([("WL000017",), ("WLabc",), ("XX000001",), (None,)], "i string")
    assert [r[0] for r in df.select(id_number("i")).collect()] == [17, None, None, None]
    assert F is not None
