"""Expectations as rows, and a run whose checks come from its writes."""

import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators.expectations import Expectation as E, as_rows, evaluate, failing_rows, from_rows, measures, observed
from stallkeeper.plans import pipeline
from stallkeeper.plans.pipeline import Job
from stallkeeper.sources.layers import RunStore

T0 = datetime(2024, 1, 1)
CATALOG = [
    E("n", "o", "rows", expected=6), E("least", "o", "rows_at_least", expected=7), E("no zero", "o", "matching", "amount <= 0", 1),
    E("some", "o", "some", "amount > 10", 2), E("filled", "o", "share", "customer is not null", 0.8), E("set", "o", "in_set", "kind", 2, ("a", "b")),
    E("customers", "o", "distinct", "customer", 3), E("known", "o", "reference", "customer", 1, parent="c.id"), E("people", "c", "rows", expected=2)]
ANSWERS = {"n": (6.0, "PASS"), "least": (6.0, "FAIL"), "no zero": (1.0, "PASS"), "some": (3.0, "PASS"), "filled": (5 / 6, "PASS"), "set": (2.0, "PASS"),
           "customers": (3.0, "PASS"), "known": (3.0, "FAIL"), "people": (3.0, "FAIL")}


def tables(spark):
    o = spark.createDataFrame([(1, 1, 20.0, "a"), (2, 1, 30.0, "b"), (3, 2, 40.0, "c"), (4, 9, 5.0, None), (5, 9, None, "a"), (6, None, -1.0, "a")],
                              "id long, customer long, amount double, kind string")
    return {"o": o, "c": spark.createDataFrame([(1,), (2,), (2,)], "id long")}


def test_a_stored_catalog_is_evaluated(spark):
    catalog = from_rows(as_rows(spark, CATALOG))
    assert catalog == CATALOG
    got = {r["label"]: (r["actual"], r["status"]) for r in evaluate(tables(spark), catalog).collect()}
    assert got == ANSWERS


def test_one_scan_for_all_plain_expectations(spark):
    df = evaluate(tables(spark), [e for e in CATALOG if e.table == "o" and e.kind not in ("distinct", "reference")])
    assert df._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_empty_tables_and_wrong_rows(spark):
    empty = {k: v.limit(0) for k, v in tables(spark).items()}
    got = {r["label"]: (r["actual"], r["status"]) for r in evaluate(empty, CATALOG).collect()}
    assert got["n"] == (0.0, "FAIL") and got["filled"] == (None, "FAIL") and got["known"] == (0.0, "FAIL")
    for bad in (dict(kind="odd"), dict(kind="rows", subject="x"), dict(kind="matching"), dict(kind="reference", subject="x")):
        with pytest.raises(ValueError):
            E("x", "t", **bad)


def test_failing_rows_are_all_shown(spark):
    got = sorted((r["label"], str(r["row_key"]), r["failing"]) for r in failing_rows(tables(spark), CATALOG, {"o": "id"}).collect())
    assert got == [("filled", "6", 1), ("known", "9", 2), ("known", "None", 1), ("no zero", "6", 1), ("set", "3", 1), ("set", "4", 1)]


def test_writes_measure_what_they_write(spark, folder):
    store = RunStore(spark, folder())
    outliers = spark.range(10).select(F.lit("orders").alias("table_name"), F.col("id").cast("string").alias("record_id"), *[F.lit(None).alias(c) for c in (
        "column_name", "value_found", "outlier_type", "percentile_rank", "expected_range", "detection_method", "severity", "detected_date")],
        F.col("id").cast("double").alias("z_score"), F.lit("d").alias("ds"))
    catalog = [E("rows", "data_outliers", "rows", expected=10), E("high", "data_outliers", "matching", "z_score > 6", 3), E("half", "data_outliers", "share", "z_score > 6", 0.5)]
    seen = store.write(outliers, "ads", "data_outliers", "r", *measures(catalog, "data_outliers"))
    got = {r["label"]: (r["actual"], r["status"]) for r in observed(spark, catalog, {"data_outliers": seen}).collect()}
    assert got == {"rows": (10.0, "PASS"), "high": (3.0, "PASS"), "half": (0.3, "FAIL")}


# ---- the job graph -------------------------------------------------------------

class Jobs:
    """Jobs over dq_rules-shaped tables that note when they were built."""

    NAMES = ("dq_rules", "customers_clean")

    def __init__(self, spark):
        self.spark, self.events, self.lock = spark, [], threading.Lock()

    def rules(self, n=2):
        return self.spark.range(n).select(F.col("id").cast("string").alias("rule_id"), *[F.lit(None).alias(c) for c in (
            "table_name", "column_name", "rule_type", "rule_definition", "threshold_value", "severity", "active", "created_date")])

    def note(self, name):
        with self.lock:
            self.events.append(name)


class Store:
    """Keeps written tables by name, so that any job name will do."""

    def __init__(self, spark):
        self.spark, self.kept = spark, {}

    def write(self, df, layer, table, run, *metrics):
        self.kept[table] = df.collect()
        return {"rows": len(self.kept[table])}

    def of_run(self, layer, table, run):
        return self.spark.createDataFrame(self.kept[table], "rule_id string, table_name string, column_name string, rule_type string, rule_definition string, "
                                          "threshold_value double, severity string, active boolean, created_date timestamp")


def test_ready_jobs_overlap_and_waiting_jobs_see_their_inputs(spark):
    jobs, gate = Jobs(spark), threading.Barrier(2, timeout=60)

    def meets(name):
        def build(made):
            gate.wait()  # passes only if both jobs run at the same time
            jobs.note(name)
            return jobs.rules()
        return build

    def last(made):
        jobs.note("last")
        return made["a"].unionByName(made["b"])

    store = Store(spark)
    seen, log = pipeline.run_jobs(store, "r", [Job("ads", "last", None, last, ("a", "b")), Job("ads", "a", None, meets("a")), Job("ads", "b", None, meets("b"))], T0)
    assert jobs.events[-1] == "last" and seen["last"]["rows"] == 4
    assert sorted(r[0] for r in log) == ["a", "b", "last"] and {r[4] for r in log} == {"SUCCESS"}


def test_a_failure_is_retried_and_stops_what_comes_after(spark):
    jobs = Jobs(spark)

    def fails(made):
        jobs.note("bad")
        raise ValueError("no such input")

    graph = [Job("ads", "bad", None, fails, retries=2), Job("ads", "slow", None, lambda _: (time.sleep(0.5), jobs.rules())[1]),
             Job("ads", "never", None, lambda made: jobs.note("never"), ("bad",))]
    with pytest.raises(ValueError, match="no such input") as e:
        pipeline.run_jobs(Store(spark), "r", graph, T0)
    assert jobs.events == ["bad"] * 3
    assert sorted((r[0], r[4]) for r in e.value.log) == [("bad", "FAILED")] * 3 + [("slow", "SUCCESS")]


def test_wrong_graphs_are_refused(spark):
    build = lambda made: None
    with pytest.raises(ValueError, match="no job for x"):
        pipeline.run_jobs(Store(spark), "r", [Job("ads", "a", None, build, ("x",))], T0)
    with pytest.raises(ValueError, match="wait for each other"):
        pipeline.run_jobs(Store(spark), "r", [Job("ads", "a", None, build, ("b",)), Job("ads", "b", None, build, ("a",))], T0)
