"""The daily run and its job log."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numbers import label
from ..operators import expectations as exp, rules
from ..operators.expectations import Expectation
from ..sources.layers import RunStore
from ..sources.tables import append_event, append_partition, conform
from . import etl, quality

# Service limits of the daily run, in seconds.
SLA_WARNING, SLA_CRITICAL = 5400, 9000
# Messages of the alerts.
ALERT_FAILED, ALERT_LATE = "ETL workflow has failed nodes", "ETL workflow is taking longer than expected"
#: Inputs that several jobs of the day read.  Lines are not among them: reading the columns that a job needs costs less than keeping all of them.
SHARED = ("customers", "orders", "products")

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Job:
    """One table of the day: built from the inputs and from the tables of the jobs it comes after."""

    layer: str
    table: str
    ds: str | None
    build: Callable[[Tables], DataFrame]
    after: tuple[str, ...] = ()
    stamp: str | None = None
    retries: int = 1


@dataclass
class DayRun:
    """What a run did: its id, (layer, table, ds, rows) of its tables, and the results of its expectations."""

    run: str
    counts: list[tuple[str, str, str | None, int]] = field(default_factory=list)
    checks: DataFrame | None = None
    log: list[tuple] = field(default_factory=list)


def daily_jobs(tables: Tables, ds: str, web_ds: str, as_of: str, variant: str = "v1") -> list[Job]:
    """The eleven tables of a day, in the published order of dependencies: quality first, the report last."""
    t, checked = tables, ("dq_assessment",)
    today = lambda df: df.withColumn("ds", F.lit(ds))
    jobs = [
        Job("ads", "dq_rules", None, lambda _: rules.rule_table(t["orders"].sparkSession, rules.standard_rules(variant)), stamp="created_date"),
        Job("ads", "dq_assessment", ds, lambda _: quality.dq_assessment(t, ds, variant), stamp="assessment_date", retries=2),
        Job("ads", "data_quality_metrics", ds, lambda _: today(etl.dq_metrics(t["customers"], t["orders"], t["products"], ds, variant)), stamp="check_timestamp"),
        Job("ads", "data_profile", ds, lambda _: today(quality.shop_profile(t["customers"], t["orders"], variant)), stamp="profile_date"),
        Job("ads", "data_outliers", ds, lambda _: today(quality.outlier_detect(t["orders"])), stamp="detected_date"),
        Job("dwd", "customer_segments", ds, lambda _: today(etl.customer_segments(t["customers"], t["orders"], as_of, variant)), checked, "updated_date"),
        Job("dwd", "product_performance", ds,
            lambda _: today(etl.product_performance(t["products"], t["order_items"], t["orders"])), checked, "analysis_date"),
        Job("ads", "web_analytics_summary", web_ds,
            lambda _: etl.web_analytics_summary(t["web_sessions"], t["page_views"], t["web_orders"], web_ds).withColumn("ds", F.lit(web_ds)), checked),
        Job("dwd", "daily_sales_summary", ds, lambda _: today(etl.daily_sales_summary(t["sales_orders"], t["order_items"], t["products"], ds)),
            ("customer_segments", "product_performance")),
        Job("ads", "dq_daily_report", ds, lambda made: today(quality.dq_daily_report(made["dq_assessment"], made["data_outliers"], ds)),
            ("dq_assessment", "data_outliers", "daily_sales_summary", "web_analytics_summary")),
    ]
    if "customers_prev" in t:
        jobs.append(Job("ads", "customer_changes", ds, lambda _: today(etl.snapshot_change_detect(
            t["customers_now"], t["customers_prev"], variant)), stamp="change_timestamp"))
    return jobs


def run_jobs(store: RunStore, run: str, jobs: list[Job], run_ts: datetime, expectations: list[Expectation] = (), side_by_side: int = 4,
             clock: Callable[[], datetime] = datetime.now, emit: Callable[[dict], None] = lambda event: None) -> tuple[dict[str, dict], list[tuple]]:
    """Write the tables of ``jobs``, each as soon as those it comes after are written; ready jobs run side by side in pools of their own.

    Returns what was observed while each table was written (its rows and the measures of its expectations) and the log; ``emit`` takes an
    event for every start and end of an attempt as it happens.  A job that
    fails is tried again ``retries`` times; then no further job starts, those under way end, and the error is raised with the log.
    """
    known = {j.table for j in jobs}
    if lost := {a for j in jobs for a in j.after} - known:
        raise ValueError(f"no job for {', '.join(sorted(lost))}")
    spark = store.spark
    made: Tables = {}
    seen: dict[str, dict] = {}
    log: list[tuple] = []

    def work(job: Job) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", job.table)
        df = job.build(made)
        df = df.withColumn(job.stamp, F.lit(run_ts)) if job.stamp else df
        return store.write(df, job.layer, job.table, run, *exp.measures(expectations, job.table))

    def attempt(job: Job) -> dict:
        for left in range(job.retries, -1, -1):
            started = clock()
            event = {"run": run, "job_name": job.table}
            emit(event | {"event": "START", "at": started})
            try:
                found = work(job)
            except Exception as e:
                emit(event | {"event": "FAILED", "at": clock(), "error": str(e)[:500]})
                log.append((job.table, job.layer.upper(), started, clock(), "FAILED", 0, str(e)[:500]))
                if not left:
                    raise
            else:
                emit(event | {"event": "SUCCESS", "at": clock(), "records": found["rows"]})
                log.append((job.table, job.layer.upper(), started, clock(), "SUCCESS", found["rows"], None))
                return found

    waiting, running, failure = list(jobs), {}, None
    with ThreadPoolExecutor(side_by_side) as pool:
        while running or (waiting and failure is None):
            ready = [j for j in waiting if failure is None and all(a in seen for a in j.after)]
            for job in ready:
                waiting.remove(job)
                running[pool.submit(inheritable_thread_target(spark)(attempt), job)] = job
            if not running:
                raise ValueError(f"jobs wait for each other: {', '.join(j.table for j in waiting)}")
            done: set[Future] = wait(running, return_when=FIRST_COMPLETED).done
            for f in done:
                job = running.pop(f)
                if f.exception() is None:
                    seen[job.table] = f.result()
                    made[job.table] = store.of_run(job.layer, job.table, run)
                else:
                    failure = failure or f.exception()
    if failure is not None:
        failure.log = log
        raise failure
    return seen, log


def run_day(spark: SparkSession, tables: Tables, root: str, ds: str, web_ds: str, as_of: str, variant: str = "v1",
            run_ts: datetime | None = None, expectations: list[Expectation] = (), clock: Callable[[], datetime] = datetime.now) -> DayRun:
    """Run all jobs of one day, validate what they wrote and publish their tables by one switch.

    Inputs that several jobs read are kept while the run lasts.  Plain expectations of the written tables are observed by the writes;
    only different values and references are looked up afterwards.  Until the switch, readers of ``RunStore.read`` see the day before, so a run
    that fails leaves nothing half new.  Every attempt of a job is logged in ``ads/etl_job_status``, whether the run is published or not,
    and its start and end are events in ``ads/job_events`` while the run goes on.
    """
    run_ts = run_ts or datetime.fromisoformat(f"{as_of}T00:00:00")
    store, out = RunStore(spark, root), DayRun(uuid.uuid4().hex)
    kept = {name: tables[name].persist(StorageLevel.MEMORY_AND_DISK) for name in SHARED if name in tables}
    try:
        jobs = daily_jobs(tables | kept, ds, web_ds, as_of, variant)
        seen, out.log = run_jobs(store, out.run, jobs, run_ts, expectations, clock=clock,
                                 emit=lambda event: append_event(spark, f"{root}/ads/job_events", event))
        written = {j.table: store.of_run(j.layer, j.table, out.run) for j in jobs}
        later = [e for e in expectations if e.kind not in exp.PLAIN]
        parts = [exp.observed(spark, expectations, seen)] if len(later) < len(expectations) else []
        parts += [exp.evaluate(tables | kept | written, later)] if later else []
        if parts:
            results = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            out.checks = spark.createDataFrame(results.collect(), results.schema)  # a row for each expectation
        out.counts = [(j.layer, j.table, j.ds, seen[j.table]["rows"]) for j in jobs]
        store.publish(out.run, [(j.layer, j.table, j.ds) for j in jobs])
    except Exception as e:
        out.log = getattr(e, "log", out.log)
        raise
    finally:
        for df in kept.values():
            df.unpersist()
        if out.log:
            save_log(spark, root, ds, out.log)
    return out


def save_log(spark: SparkSession, root: str, ds: str, log: list[tuple]) -> None:
    jobs = spark.createDataFrame(log, "job_name string, job_type string, start_time timestamp, end_time timestamp, status string, "
                                      "records_processed bigint, error_message string").coalesce(1)
    append_partition(conform(jobs.withColumn("ds", F.lit(ds)), "ads", "etl_job_status"), f"{root}/ads/etl_job_status", ds)


def daily_pipeline(spark: SparkSession, tables: Tables, root: str, ds: str, web_ds: str, as_of: str, variant: str = "v1",
                   run_ts: datetime | None = None) -> DataFrame:
    """``run_day`` as a table: (layer, table_name, ds, row_count), the counts observed while writing."""
    counts = run_day(spark, tables, root, ds, web_ds, as_of, variant, run_ts).counts
    return spark.createDataFrame(counts, "layer string, table_name string, ds string, row_count bigint")


def job_sla_report(jobs: DataFrame, warning: int = SLA_WARNING, critical: int = SLA_CRITICAL) -> DataFrame:
    """Duration class of each logged run, with the alert it raises."""
    seconds = F.unix_timestamp("end_time") - F.unix_timestamp("start_time")
    failed = F.col("status") == "FAILED"
    level = label([(failed, "FAILED"), (F.col("duration_seconds") > critical, "CRITICAL"),
                   (F.col("duration_seconds") > warning, "WARNING")], "OK")
    alert = F.when(failed, ALERT_FAILED).when(F.col("duration_seconds") > warning, ALERT_LATE)
    return jobs.withColumn("duration_seconds", seconds).select(
        "job_name", "status", "duration_seconds", level.alias("sla_level"), alert.alias("alert_message"))
