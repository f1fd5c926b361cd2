"""Property checks: window counts against brute force, money text against the
rounding rule, rescued data against a direct computation."""

import collections
import datetime as dt
import json
import math

from hypothesis import HealthCheck, given, settings, strategies as st

from cardsentry.functions.parsing import rescued_data
from cardsentry.functions.text import money_text
from cardsentry.operators.windows import sliding_counts, tumbling_counts
from pyspark.sql import types as T

BASE = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=6 * 3600 - 1), min_size=1, max_size=80))
def test_window_counts_brute_force(spark, seconds):
    times = [BASE + dt.timedelta(seconds=s) for s in seconds]
    df = spark.createDataFrame([(t,) for t in times], "transaction_timestamp timestamp")
    tumbling = {r.window_start: r.transactions_count for r in tumbling_counts(df).collect()}
    expect = collections.Counter(t.replace(second=0) for t in times)
    assert tumbling == dict(expect)
    sliding = {r.window_start: r.transactions_count for r in sliding_counts(df).collect()}
    expect = collections.Counter(t.replace(second=0) - dt.timedelta(minutes=k) for t in times for k in range(5))
    assert sliding == dict(expect)
    assert sum(sliding.values()) == 5 * len(times)


def cents_text(x):
    cents = math.floor(x * 100 + 0.5)
    sign = "-" if cents < 0 else ""
    return f"{sign}{abs(cents) // 100}.{abs(cents) % 100:02d}"


@SETTINGS
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=1, max_size=50))
def test_money_text_rule(spark, values):
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double")
           .select(money_text("x")).collect()]
    assert got == [cents_text(v) for v in values]


SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
json_values = st.one_of(st.none(), st.integers(-10**6, 10**6), st.text("abc", max_size=3), st.booleans())


@SETTINGS
@given(st.dictionaries(st.sampled_from(["a", "n", "x", "y"]), json_values, max_size=4))
def test_rescued_data_direct(spark, obj):
    text = json.dumps(obj, separators=(",", ":"))
    got = spark.createDataFrame([(text,)], "value string").select(rescued_data("value", SCHEMA)).first()[0]
    lost = {}
    for k, v in obj.items():
        if k == "n":
            if v is not None and (not isinstance(v, int) or isinstance(v, bool)):
                lost[k] = v
        elif k != "a":              # not in the schema: kept, even when null
            lost[k] = v
    if not lost:
        assert got is None
    else:
        assert set(json.loads(got)) == set(lost)


TEXT_SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
leaf = st.one_of(st.none(), st.integers(-99, 99), st.text("xy", max_size=2), st.booleans())
json_any = st.recursive(leaf, lambda inner: st.one_of(st.lists(inner, max_size=2),
                                                      st.dictionaries(st.sampled_from(["p", "q"]), inner, max_size=2)),
                        max_leaves=4)


@SETTINGS
@given(st.lists(st.one_of(
    st.dictionaries(st.sampled_from(["a", "b", "c"]), json_any, max_size=3).map(
        lambda d: json.dumps(d, separators=(",", ":"))),
    st.sampled_from(["{bad", "[1,2]", "null", "{}", "7"])), min_size=1, max_size=8))
def test_single_parse_equals_general_path(spark, tmp_dir, lines):
    from cardsentry.functions.parsing import parse_json
    from cardsentry.sources.files import read_json_records
    import uuid
    path = f"{tmp_dir}/f{uuid.uuid4().hex}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    fast = read_json_records(spark, path, TEXT_SCHEMA).select("a", "b", "_rescued_data")
    raw = spark.read.text(path)
    general = raw.select(parse_json("value", TEXT_SCHEMA).alias("d"),
                         rescued_data("value", TEXT_SCHEMA).alias("_rescued_data")) \
        .select("d.a", "d.b", "_rescued_data")
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(map(tuple, fast.collect()), key=key) == sorted(map(tuple, general.collect()), key=key)
