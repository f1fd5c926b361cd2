from pyspark.sql import functions as F

from cardsentry.operators.joins import maybe_broadcast
from cardsentry.operators.layers import latest_customers
from cardsentry.operators.resume import unpublished
from cardsentry.schemas import WATCHLIST_RECORD
from cardsentry.sources import driver_tables as D
from cardsentry.sources.files import read_json_records, stored_schema, stream_json_records
from cardsentry.sources.paths import folder_size, list_names
from cardsentry.streaming.sinks import finish, stream_to_path


def records(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "watchlist_id string")


def test_high_water_mark(spark):
    target = records(spark, ["WL000001", "WL000002", "WL000003", "WLxx"])
    source = records(spark, [f"WL00000{i}" for i in range(1, 6)])
    assert sorted(r[0] for r in unpublished(source, target).collect()) == ["WL000004", "WL000005"]
    empty = spark.createDataFrame([], "watchlist_id string")
    assert unpublished(source, empty).count() == 5


def test_json_files_rescued_and_lineage(spark, tmp_dir):
    lines = ['{"watchlist_id":"WL1","entity_id":"4000","risk_level":"high"}',
             '{"watchlist_id":"WL2","entity_id":"4001","note":"x"}',
             '{"watchlist_id":"WL3"']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/feed/day=1")
    batch = read_json_records(spark, f"{tmp_dir}/feed", WATCHLIST_RECORD)
    got = {r.watchlist_id: r._rescued_data for r in batch.collect()}
    assert got == {"WL1": None, "WL2": '{"note":"x"}', None: '{"watchlist_id":"WL3"'}
    assert batch.where(F.col("source_file").contains("day=1")).count() == 3
    stream = stream_json_records(spark, f"{tmp_dir}/feed", WATCHLIST_RECORD)
    finish(stream_to_path(stream, f"{tmp_dir}/bronze", f"{tmp_dir}/ck"))
    spark.createDataFrame([('{"watchlist_id":"WL4"}',)], "value string").write.text(f"{tmp_dir}/feed/day=2")
    stream = stream_json_records(spark, f"{tmp_dir}/feed", WATCHLIST_RECORD)
    finish(stream_to_path(stream, f"{tmp_dir}/bronze", f"{tmp_dir}/ck"))
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 4     # each file once


def test_stored_schema(spark, tmp_dir):
    spark.createDataFrame([('{"a":"x","n":1}',)], "value string").write.text(f"{tmp_dir}/in")
    first = stored_schema(spark, f"{tmp_dir}/in", f"{tmp_dir}/schema")
    spark.createDataFrame([('{"a":"y","n":2,"extra":true}',)], "value string") \
        .write.mode("append").text(f"{tmp_dir}/in")
    again = stored_schema(spark, f"{tmp_dir}/in", f"{tmp_dir}/schema")
    assert first == again and "extra" not in again.fieldNames()


def test_latest_customer_and_broadcast_check(spark):
    df = spark.createDataFrame([("c1", "old@x", 1), ("c1", "new@x", 2), ("c2", "b@x", 1)],
                               "customer_id string, email string, silver_ingestion_timestamp int")
    got = {r.customer_id: r.email for r in latest_customers(df).collect()}
    assert got == {"c1": "new@x", "c2": "b@x"}
    small = spark.range(10)
    hinted = maybe_broadcast(small, 1 << 20)
    plan = spark.range(100).join(hinted, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    refused = maybe_broadcast(small, 1)          # above the limit: left to the planner
    assert refused is small


def test_stream_with_stored_schema(spark, tmp_dir):
    spark.createDataFrame([('{"watchlist_id":"W1","risk":"high"}',)], "value string") \
        .write.text(f"{tmp_dir}/feed/d=1")
    stream = stream_json_records(spark, f"{tmp_dir}/feed", schema_location=f"{tmp_dir}/schema")
    finish(stream_to_path(stream, f"{tmp_dir}/bronze", f"{tmp_dir}/ck"))
    spark.createDataFrame([('{"watchlist_id":"W2","risk":"low","extra":1}',)], "value string") \
        .write.text(f"{tmp_dir}/feed/d=2")
    stream = stream_json_records(spark, f"{tmp_dir}/feed", schema_location=f"{tmp_dir}/schema")
    finish(stream_to_path(stream, f"{tmp_dir}/bronze", f"{tmp_dir}/ck"))
    got = {r.watchlist_id: (r.risk, r._rescued_data) for r in spark.read.parquet(f"{tmp_dir}/bronze").collect()}
    assert got == {"W1": ("high", None), "W2": ("low", '{"extra":"1"}')}


def test_jdbc_partitioned_read_arguments():
    """No database may be started here: check the calls with a stand-in reader."""
    from types import SimpleNamespace

    from cardsentry.sources.jdbc import read_jdbc_table
    calls = []

    class Reader:
        def jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None,
                 properties=None):
            calls.append((table, column, lowerBound, upperBound, numPartitions, dict(properties)))
            return SimpleNamespace(first=lambda: {"lo": 5, "hi": 905})

    fake = SimpleNamespace(read=Reader())
    read_jdbc_table(fake, "jdbc:x", "customers", user="u", password="p", partition_column="id",
                    num_partitions=16)
    assert calls[0][0].startswith("(SELECT min(id) AS lo, max(id) AS hi FROM customers)")
    assert calls[1][:5] == ("customers", "id", 5, 905, 16)
    assert calls[1][5] == {"fetchsize": "10000", "user": "u", "password": "p"}


def test_jdbc_equal_depth_predicates():
    """Skewed ids: slices of equal depth, each row in exactly one of them."""
    import sqlite3
    from types import SimpleNamespace

    from cardsentry.sources.jdbc import depth_bounds, depth_predicates, read_jdbc_table
    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE customers (id INTEGER, name TEXT)")
    rows = [(i, f"o'{i}") for i in range(90)] + [(10 ** 9 + i, "far") for i in range(10)] + [(7, "hot")] * 40 + [(None, None)] * 5
    con.executemany("INSERT INTO customers VALUES (?, ?)", rows)
    calls = []

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            calls.append(predicates)
            return SimpleNamespace(collect=lambda: [{"hi": r[0]} for r in con.execute(f"SELECT * FROM {table}")])

    fake = SimpleNamespace(read=Reader())
    for column, value in (("id", lambda r: r[0]), ("name", lambda r: r[1])):
        bounds = depth_bounds(fake, "jdbc:x", "customers", column, 7, {})
        read_jdbc_table(fake, "jdbc:x", "customers", partition_column=column, num_partitions=7, equal_depth=True)
        assert calls[-1] == depth_predicates(column, bounds)
        sizes = [con.execute(f"SELECT count(*) FROM customers WHERE {p}").fetchone()[0] for p in calls[-1]]
        assert sum(sizes) == len(rows) and len(sizes) <= 7
        assert max(sizes) <= len(rows) // 7 + 41                # a slice, and the hot value
    assert depth_predicates("id", [3]) == depth_predicates("id", []) == ["id IS NULL OR id IS NOT NULL"]


def test_files_of_the_feed_do_not_grow_with_its_months(spark, tmp_dir):
    lines = spark.range(2000).select(F.concat(F.lit('{"watchlist_id":"WL'), "id", F.lit('"}')).alias("value"),
                                     F.concat(F.lit("m"), F.col("id") % 200).alias("effective_month"))
    for k in range(2):                                      # two drops
        D.write_feed(lines.where(F.col("id") % 2 == k), f"{tmp_dir}/feed")
    assert folder_size(spark, f"{tmp_dir}/feed")[1] == 2 and not [n for n in list_names(spark, f"{tmp_dir}/feed") if "=" in n]
    D.write_feed(lines, f"{tmp_dir}/by_month", "effective_month")
    assert len([n for n in list_names(spark, f"{tmp_dir}/by_month") if n.startswith("effective_month=m")]) == 200
    for path in ("feed", "by_month"):
        found = read_json_records(spark, f"{tmp_dir}/{path}", WATCHLIST_RECORD).select("watchlist_id").collect()
        assert sorted(r[0] for r in found) == sorted(f"WL{i}" for i in range(2000))
