"""Streaming jobs over several batches."""

from datetime import datetime


from stallkeeper.plans.features import newer_than_target
from stallkeeper.streaming import jobs
from stallkeeper.streaming.merge_store import MergeStore


def test_incremental_load_takes_only_new_files(spark, folder):
    inbox, target, mark = folder(), folder(), folder()
    schema = "id long, ts timestamp"
    for day in (1, 2):
        spark.createDataFrame([(day, datetime(2024, 1, day))], schema).coalesce(1).write.mode("append").parquet(inbox)
        for _ in range(2):
            stream = jobs.file_stream(spark, inbox, spark.read.parquet(inbox).schema)
            jobs.finish(jobs.incremental_load(stream, target, mark))
        assert spark.read.parquet(target).count() == day


def test_high_water_mark(spark):
    src = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id long, ts long")
    ids = lambda t: {r["id"] for r in newer_than_target(src, t, "ts").collect()}
    assert ids(src.filter("ts <= 20")) == {3} and ids(src.limit(0)) == {1, 2, 3}


def test_dashboard_updates_windows_across_batches(spark, folder):
    inbox, target, mark = folder(), folder(), folder()
    schema = "ts timestamp, event_type string, value double"
    at = lambda h, m: datetime(2024, 1, 1, h, m)
    batches = [[(at(1, 5), "purchase", 2.5), (at(1, 50), "view", 0.0)], [(at(1, 59), "purchase", 1.0), (at(2, 1), "click", 0.0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        jobs.finish(jobs.dashboard_stream(jobs.file_stream(spark, inbox, spark.read.parquet(inbox).schema), target, mark))
    got = {r["window_start"].hour: (r["events"], r["purchases"], r["purchase_value"]) for r in jobs.dashboard_table(spark, target).collect()}
    assert got == {1: (3, 2, 3.5), 2: (1, 0, 0.0)}


PERSON = "customer_id long, first_name string, last_name string, email string"
CHANGE = "customer_id long, change_type string, new_data string, change_timestamp timestamp"


def payload(name):
    return '{"first_name":"%s","last_name":"L","email":"e"}' % name


def test_change_stream_merges_in_order(spark, folder):
    inbox, mark = folder(), folder()
    store = MergeStore(spark, folder(), PERSON, buckets=8)
    store.create(spark.createDataFrame([(1, "A", "L", "e"), (2, "B", "L", "e")], PERSON))
    day = lambda d: datetime(2024, 1, d)
    batches = [[(1, "UPDATE", payload("A2"), day(2)), (1, "UPDATE", payload("A1"), day(1)), (3, "INSERT", payload("C"), day(1))],
               [(2, "DELETE", None, day(3)), (3, "UPDATE", payload("C2"), day(3))]]
    for rows in batches:
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(inbox)
        jobs.finish(jobs.cdc_stream(jobs.file_stream(spark, inbox, spark.read.parquet(inbox).schema), store, mark))
    assert {r["customer_id"]: r["first_name"] for r in store.read().collect()} == {1: "A2", 3: "C2"}
    assert store.version() == 2


def test_a_batch_rewrites_its_buckets_only(spark, folder):
    store = MergeStore(spark, folder(), PERSON, buckets=16)
    base = spark.range(500).selectExpr("id customer_id", "concat('n', id) first_name", "'L' last_name", "'e' email")
    store.create(base)
    keys = [3, 77, 499, 9001]
    changes = spark.createDataFrame([(k, "UPDATE", payload("new"), datetime(2024, 1, 1)) for k in keys], CHANGE)
    touched = store.merge(changes, 0, "change_timestamp")
    assert 0 < len(touched) <= len(keys)
    held = store.held(1)
    assert sorted(b for b, at in held.items() if at == 1) == touched and len(held) == 16
    once = sorted(map(tuple, store.read().collect()))
    assert len(once) == 501 and sum(r[1] == "new" for r in once) == 4
    store.merge(changes, 0, "change_timestamp")  # a replay
    assert sorted(map(tuple, store.read().collect())) == once
    assert sorted(map(tuple, store.read(0).collect())) == sorted(map(tuple, base.collect()))  # the version before is kept
    plan = store.read(only=[touched[0]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_old_versions_are_removed(spark, folder):
    root = folder()
    store = MergeStore(spark, root, PERSON, buckets=4, keep=2)
    store.create(spark.range(40).selectExpr("id customer_id", "'a' first_name", "'L' last_name", "'e' email"))
    for v in range(4):
        every = spark.createDataFrame([(k, "UPDATE", payload(f"v{v}"), datetime(2024, 1, 1)) for k in range(40)], CHANGE)
        store.merge(every, v, "change_timestamp")
    left = {r["version"] for r in spark.read.parquet(f"{root}/data").select("version").distinct().collect()}
    assert left == {3, 4} and {r["first_name"] for r in store.read().collect()} == {"v3"}
    store.merge(spark.createDataFrame([], CHANGE), 4, "change_timestamp")
    assert store.version() == 5 and store.read().count() == 40
    store.merge(spark.createDataFrame([(k, "DELETE", None, datetime(2024, 1, 2)) for k in range(40)], CHANGE), 5, "change_timestamp")
    assert store.read().count() == 0
