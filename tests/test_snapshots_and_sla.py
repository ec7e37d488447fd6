"""Hash-tree difference of snapshots, and service limits as a stateful stream."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stallkeeper.plans import etl
from stallkeeper.sources import snapshots, tables
from stallkeeper.streaming import jobs, sla

PERSON = "customer_id bigint, first_name string, last_name string, email string"


def people(spark, n):
    return spark.range(n).selectExpr("id customer_id", "concat('n', id) first_name", "'L' last_name", "if(id % 7 = 0, null, 'e') email")


def saved(spark, folder, df):
    path = folder()
    snapshots.save_snapshot(df, path)
    return path


def test_same_changes_as_the_full_join(spark, folder):
    old = people(spark, 400)
    new = old.filter("customer_id not in (5, 77)").withColumn("first_name", F.when(F.col("customer_id") == 123, None).otherwise(F.col("first_name"))).unionByName(
        people(spark, 402).filter("customer_id >= 400"))
    a, b = saved(spark, folder, old), saved(spark, folder, new)
    for how in ({"null_safe": True}, {"variant": "v2"}):
        got = snapshots.snapshot_diff(spark, a, b, PERSON, **how)
        assert sorted(map(str, got.collect())) == sorted(map(str, etl.snapshot_change_detect(new, old, **how).collect()))
    leaves = snapshots.differing_leaves(spark, a, b)
    assert 1 <= len(leaves) <= 5
    files = snapshots.read_leaves(spark, b, leaves, PERSON).inputFiles()
    plan = snapshots.read_leaves(spark, b, leaves, PERSON)._jdf.queryExecution().executedPlan().toString()
    assert files and "PartitionFilters: [" in plan and "leaf" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_equal_snapshots_end_at_the_root(spark, folder):
    a, b = saved(spark, folder, people(spark, 300)), saved(spark, folder, people(spark, 300).orderBy(F.desc("customer_id")))
    assert snapshots.differing_leaves(spark, a, b) == []
    assert snapshots.snapshot_diff(spark, a, b, PERSON).count() == 0


def test_repeated_rows_null_keys_and_empty_snapshots(spark, folder):
    df = people(spark, 50)
    twice, odd, none = df.unionByName(df.limit(1)), df.unionByName(spark.createDataFrame([(None, "x", None, None)], PERSON)), df.limit(0)
    paths = [saved(spark, folder, x) for x in (df, twice, odd, none)]
    for other in paths[1:]:
        assert snapshots.differing_leaves(spark, paths[0], other)
    assert snapshots.snapshot_diff(spark, paths[3], paths[0], PERSON).filter("change_type = 'INSERT'").count() == 50
    assert snapshots.differing_leaves(spark, paths[3], paths[3]) == []


T0 = datetime(2024, 5, 1, 2)


def event(job, what, minutes, run="r1"):
    return {"run": run, "job_name": job, "event": what, "at": T0 + timedelta(minutes=minutes)}


@pytest.fixture
def follow(spark, folder):
    inbox, target, mark = folder("events"), folder("rows"), folder("mark")

    def run(*events):
        for e in events:
            tables.append_event(spark, inbox, e)
        stream = spark.readStream.schema(tables.EVENT).json(inbox)
        jobs.finish(sla.sla_stream(stream, target, mark))
        rows = spark.read.schema(sla.ROW).parquet(target).filter("run = 'r1'").collect()
        return sorted((r["job_name"], r["status"], r["attempts"], r["duration_seconds"], r["sla_level"]) for r in rows)

    return run


def test_ends_retries_and_slow_jobs(follow):
    got = follow(event("a", "START", 0), event("a", "SUCCESS", 10), event("b", "START", 0), event("b", "FAILED", 5), event("b", "START", 6), event("b", "SUCCESS", 95),
                 event("c", "START", 0), event("c", "SUCCESS", 200))
    assert got == [("a", "SUCCESS", 1, 600, "OK"), ("b", "FAILED", 1, 300, "FAILED"), ("b", "SUCCESS", 2, 5700, "WARNING"), ("c", "SUCCESS", 1, 12000, "CRITICAL")]


def test_a_missing_end_raises_both_limits_while_the_job_runs(follow):
    assert follow(event("a", "START", 0), event("b", "START", 1)) == []
    assert follow(event("b", "SUCCESS", 60)) == [("b", "SUCCESS", 1, 3540, "OK")]
    late = [("a", "RUNNING", 1, 5400, "WARNING"), ("b", "SUCCESS", 1, 3540, "OK")]
    assert follow(event("x", "START", 100, "r2")) == late
    late.insert(1, ("a", "RUNNING", 1, 9000, "CRITICAL"))
    assert follow(event("x", "SUCCESS", 170, "r2")) == late
    assert follow(event("a", "SUCCESS", 180)) == sorted([*late, ("a", "SUCCESS", 1, 10800, "CRITICAL")])
