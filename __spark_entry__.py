
from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracles import all_oracles  # noqa: E402
from stallkeeper.functions import sqlfuncs  # noqa: E402
from stallkeeper.operators import rules  # noqa: E402
from stallkeeper.plans import (  # noqa: E402
    analytics, basic, etl, features, pipeline, quality, text_jobs, validation,
)
from stallkeeper.operators.expectations import Expectation, as_rows, evaluate, failing_rows, from_rows  # noqa: E402
from stallkeeper.session import has_staging_root, name_staging_root, parts_for, shuffle_width, stage, staging_path  # noqa: E402
from stallkeeper.sources import layers, schemas, snapshots, synth, tables  # noqa: E402
from stallkeeper.sources.adapters import AS_OF, BIZDATE, WEB_DATE, Shop  # noqa: E402
from stallkeeper.streaming import jobs as streams, sla  # noqa: E402
from stallkeeper.streaming.merge_store import MergeStore  # noqa: E402

try:  # the subpackage and the pipeline may be absent
    import corpus_pipeline
    from stallkeeper.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]
RETENTION_AS_OF = "2001-08-02"
CUTOFF = "2001-03-01"


def entry(spark: SparkSession) -> DataFrame:
    return queries()["daily_sales_summary"](spark, "/root/testdata/sf0.001")


def _with_folder(query: Query) -> Query:
    """Only a local session without a shared folder gets one of its own."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not has_staging_root(spark) and spark.sparkContext.master.startswith("local["):
            name_staging_root(spark, tempfile.mkdtemp(prefix="stallkeeper-"))
        return query(spark, sf_dir)
    return run


def _shop(job: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(Shop(spark, sf_dir))


# ---- helpers for jobs that write ------------------------------------------

def _csv_ingest(s: Shop) -> DataFrame:
    """Products written as CSV with shuffled columns and damaged lines, read by name: good rows and rejects per reason."""
    path, rejects = staging_path(s.spark, "csv"), staging_path(s.spark, "rejects")
    k, text = F.col("product_id"), lambda c: F.col(c).cast("string")
    price = F.when(k % 53 == 0, F.lit("n/a")).otherwise(F.col("price").cast("double").cast("string"))
    line = F.concat_ws(",", "brand", price, text("product_id"), "product_name", "category", F.col("cost").cast("double").cast("string"))
    line = F.when(k % 59 == 1, F.concat(line, F.lit(",more"))).when(k % 61 == 2, F.concat_ws(",", "brand", price)).otherwise(line)
    head = "brand,price,product_id,product_name,category,cost"
    s.products.select(line.alias("value")).write.text(path)
    good = tables.csv_ingest(s.spark, path, "products", head.split(","), rejects).select(
        "product_id", "product_name", "brand", "category", "price", "cost", F.lit(None).cast("string").alias("reason"), F.lit(1).cast("bigint").alias("rows"))
    bad = s.spark.read.parquet(rejects).groupBy("reason").agg(F.count("*").alias("rows"))
    return good.unionByName(bad, allowMissingColumns=True)


_EVENT_FIELDS = ["event_id", "session_id", "user_id", "event_type", "event_timestamp", "page_url", "element_id",
                 "element_type", "event_data"]


def _event_lines(s: Shop) -> str:
    """Event log as text; every 7th row has an unquoted comma in its last field."""
    path = staging_path(s.spark, "lines")
    data = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("products:P1,P"), F.col("event_id").cast("string"))).when(
        F.col("event_id") % 7 == 1, F.concat(F.lit('"products:P1,P'), F.col("event_id").cast("string"), F.lit('"'))
    ).otherwise(F.concat(F.lit("value:"), F.col("event_id").cast("string")))
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.concat(F.lit("S"), F.col("user_id").cast("string")),
                       F.col("user_id").cast("string"), "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                       F.lit("/p"), F.lit(""), F.lit("button"), data)
    s.base("events").select(line.alias("value")).write.text(path)
    return path


def _quarantine(s: Shop) -> DataFrame:
    good, bad = tables.quarantine(s.spark, _event_lines(s), _EVENT_FIELDS)
    good = good.groupBy("event_type").agg(F.count("*").alias("rows"), F.sum(F.length("event_data")).alias("data_chars"))
    bad = bad.select(F.split(tables.CORRUPT, ",")[3].alias("event_type")).groupBy("event_type").agg(
        F.count("*").alias("rows"), F.lit(None).cast("bigint").alias("data_chars"))
    return good.withColumn("kind", F.lit("good")).unionByName(bad.withColumn("kind", F.lit("quarantined")))


def _static_partition(s: Shop) -> DataFrame:
    """Orders loaded into one partition; amounts that are no numbers are rejected and listed."""
    raw, target, rejects = (staging_path(s.spark, x) for x in ("csv", "orders", "rejects"))
    amount = F.when(F.col("order_id") % 97 == 0, F.lit("unknown")).otherwise(F.col("total_amount").cast("double").cast("string"))
    s.orders.select("order_id", "customer_id", "order_date", "order_status", amount.alias("total_amount"),
                    "payment_method").write.option("header", True).csv(raw)
    tables.overwrite_partition(tables.csv_ingest(s.spark, raw, "orders", rejects=rejects), target, BIZDATE)
    part = lambda c: F.get_json_object("line", f"$.{c}").alias(c)
    bad = s.spark.read.parquet(rejects).select(part("order_id"), part("customer_id"), F.col("reason").alias("order_status"),
                                               F.lit(None).cast("double").alias("total_amount"), F.lit("rejected").alias("ds"))
    return tables.read_table(s.spark, target).select("order_id", "customer_id", "order_status", "total_amount", "ds").unionByName(bad)


def _literal_rows(s: Shop) -> DataFrame:
    seed = s.spark.createDataFrame(
        [("N-1", "Ada", "Lund", "UNITED STATES"), ("N-2", "Bo", "Reyes", "UNITED STATES"), ("N-3", "Cleo", "Marsh", "UNITED KINGDOM")],
        "customer_id string, first_name string, last_name string, country string")
    people = s.customers.select(F.col("customer_id").cast("string").alias("customer_id"), "first_name", "last_name", "country")
    return basic.customers_per_country(people.unionByName(seed))


def _two_loads(s: Shop) -> tuple[str, DataFrame]:
    path = staging_path(s.spark, "loads")
    slim = s.orders.select("order_id", F.col("total_amount").cast("double").alias("total_amount"), "ds")
    # few files per month, and a month with most of the rows is split
    slim.hint("rebalance", "ds").write.partitionBy("ds").parquet(path)
    return path, slim


def _overwrite_partition(s: Shop) -> DataFrame:
    """One month is corrected (doubled) twice; the others stay."""
    path, slim = _two_loads(s)
    fixed = slim.filter(F.col("ds") == BIZDATE).withColumn("total_amount", F.col("total_amount") * 2)
    for _ in range(2):
        tables.overwrite_partition(fixed, path, BIZDATE)
    return tables.read_table(s.spark, path)


def _append_partition(s: Shop) -> DataFrame:
    """A rerun of an append duplicates rows, an idempotent one does not."""
    path, slim = _two_loads(s)
    month = slim.filter(F.col("ds") == BIZDATE)
    tables.append_partition(month, path, BIZDATE)
    twice = tables.read_table(s.spark, path).groupBy("ds").agg(F.count("*").alias("appended"))
    other = staging_path(s.spark, "loads")
    for _ in range(2):
        tables.append_partition(month, other, BIZDATE, idempotent=True)
    once = tables.read_table(s.spark, other).groupBy("ds").agg(F.count("*").alias("idempotent"))
    return twice.join(once, "ds", "left")


def _overwrite_table(s: Shop) -> DataFrame:
    path = staging_path(s.spark, "clean")
    tables.overwrite_table(s.customers.select("customer_id", F.col("email").alias("email_clean")), path)
    tables.overwrite_table(quality.customers_clean(s.dirty_customers).select("customer_id", "email_clean"), path)
    return s.spark.read.parquet(path)


def _retention(s: Shop) -> DataFrame:
    path, _ = _two_loads(s)
    days = schemas.RETENTION_DAYS["orders"]
    report = stage(tables.retention_report(tables.read_table(s.spark, path), days, RETENTION_AS_OF), "report")
    tables.apply_retention(s.spark, path, days, RETENTION_AS_OF)
    kept = tables.read_table(s.spark, path).groupBy("ds").agg(F.count("*").alias("rows_after"))
    return report.join(kept, "ds", "left")


def _row_counts(s: Shop) -> DataFrame:
    return tables.table_row_counts({
        "customers": s.customers, "products": s.products, "orders": s.orders, "order_items": s.order_items,
        "web_sessions": s.web_sessions, "page_views": s.page_views, "user_events": s.base("events"), "suppliers": s.suppliers})


def _typed_view(s: Shop) -> DataFrame:
    """Order dates as text, some of them damaged, cast and counted per status."""
    damaged = F.when(F.col("order_id") % 10 == 0, F.lit("n/a")).when(F.col("order_id") % 15 == 1, F.lit("2001-13-45")).when(
        F.col("order_id") % 21 == 2, F.lit(None)).otherwise(F.date_format("order_date", "yyyy-MM-dd HH:mm:ss"))
    typed = tables.typed_view(s.orders.select("order_status", damaged.alias("order_date")), ["order_date"])
    return typed.groupBy("order_status").agg(
        F.count("*").alias("rows"), F.count("order_date_typed").alias("typed"),
        F.sum(F.col("order_date_rejected").cast("bigint")).alias("rejected"),
        F.date_format(F.max("order_date_typed"), "yyyy-MM-dd").alias("last_day"))


_MADE: dict[tuple[str, str, str], object] = {}


def _once(s: Shop, name: str, make: Callable[[Shop], object]):
    """What several queries of a session read and only the first one writes."""
    key = (s.spark.sparkContext.applicationId, s.sf_dir, name)
    if key not in _MADE:
        _MADE[key] = make(s)
    return _MADE[key]


def _fill_layers(s: Shop) -> tuple[str, dict[str, int]]:
    """All declared tables created empty, the raw ones then loaded into their ``ds`` folders; the folder and the rows counted by the writes."""
    root = staging_path(s.spark, "layers")
    layers.create_layers(s.spark, root)
    n_orders, n_lines = s.base("orders").count(), s.base("lineitem").count()
    months = s.orders.select("order_id", "ds")
    # the months of the orders are hashed, the lines stream past them unsorted; a task holds a million orders at most
    if (parts := parts_for(s.spark, n_orders)) > shuffle_width(s.spark):
        months = months.repartition(parts, "order_id")
    lines = s.base("lineitem").join(months.hint("shuffle_hash"), F.col("l_orderkey") == F.col("order_id"), "left").drop("order_id")
    day = F.date_format("ts", "yyyyMMdd")
    events = s.base("events").withColumns({"session_id": F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")),
                                           "event_timestamp": F.col("ts").cast("string"), "ds": day})
    raw = {"customers": s.customers, "products": s.products, "orders": s.orders, "order_items": lines,
           "web_sessions": s.web_sessions, "page_views": s.page_views.withColumnRenamed("ts", "timestamp"), "user_events": events,
           "suppliers": s.suppliers, "customers_snapshot": s.shop_customers_prev.withColumn("ds", F.lit(BIZDATE))}
    how = {"order_items": {"rows": n_lines, "key": "l_orderkey", "shape": lambda moved: s.items_of(moved, "ds")}}
    return root, {t: layers.load_layer(df, root, "ods", t, **how.get(t, {})) for t, df in raw.items()}


def _layer(s: Shop, table: str, layer: str = "ods") -> DataFrame:
    return layers.read_layer(s.spark, _once(s, "layers", _fill_layers)[0], layer, table)


def _layered(s: Shop) -> DataFrame:
    """Every declared table as it is read back: its columns, rows and days."""
    parts = []
    for layer, declared in schemas.LAYERS.items():
        for table in declared:
            df = _layer(s, table, layer)
            days = F.countDistinct("ds") if layers.by_day(layer, table) else F.lit(0)
            parts.append(df.agg(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.lit(len(df.columns)).cast("bigint").alias("columns"),
                                F.count("*").alias("rows"), days.cast("bigint").alias("days")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _orders_by_day(s: Shop) -> DataFrame:
    """The partitioned raw orders with typed keys; ``ds`` comes from the folder names."""
    key = lambda c: F.col(c).cast("bigint").alias(c)
    return _layer(s, "orders").select(key("order_id"), key("customer_id"), "order_status", "total_amount", "ds")


def _calendar(s: Shop) -> DataFrame:
    """Run dates of the orders layer with their year and quarter, as a table of its own."""
    def make(s: Shop) -> DataFrame:
        d = F.to_date("ds", "yyyyMMdd")
        return stage(_layer(s, "orders").select("ds").distinct().select("ds", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month")), "calendar")
    return _once(s, "calendar", make)


def _run_dates(s: Shop) -> DataFrame:
    return basic.orders_on_run_dates(_orders_by_day(s), _calendar(s).filter("year = 1996 and month = quarter * 3"))


def _job_status(s: Shop) -> DataFrame:
    root = staging_path(s.spark, "status")
    summary = etl.daily_sales_summary(s.month_of_orders(BIZDATE), s.order_items, s.products, BIZDATE)
    tables.overwrite_partition(tables.conform(summary.withColumn("ds", F.lit(BIZDATE)), "dwd", "daily_sales_summary"), f"{root}/sales", BIZDATE)
    written = tables.read_table(s.spark, f"{root}/sales")
    start = datetime(1996, 9, 2, 2, 0, 0)
    return tables.log_job(s.spark, f"{root}/log", BIZDATE, "daily_sales_summary", "FACT_TABLE", start,
                          start + timedelta(minutes=12), written)


def _web_day(s: Shop) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sessions, page views and purchases of the run date; sessions never cross midnight."""
    return tuple(s.on_day(v, WEB_DATE) for v in ("shop_web_sessions", "shop_page_views", "shop_purchases"))


# ---- data quality ----------------------------------------------------------

def _dirty(s: Shop) -> dict[str, DataFrame]:
    return {"customers": s.dirty_customers, "orders": s.dirty_orders, "products": s.dirty_products}


def _assessed(s: Shop, variant: str = "v2") -> DataFrame:
    return quality.dq_assessment(_dirty(s), BIZDATE, variant)


def _profile(s: Shop, variant: str) -> DataFrame:
    """Deviation to six decimals: the last bits of a double differ between engines."""
    return quality.shop_profile(s.dirty_customers, s.dirty_orders, variant).withColumn("std_dev", F.round("std_dev", 6))


def _rule_catalog(s: Shop) -> DataFrame:
    """Rule catalog with the number of records each rule covers."""
    sizes = tables.table_row_counts(_dirty(s))
    return rules.rule_table(s.spark, rules.standard_rules("v2")).join(sizes, "table_name", "left")


def _day_trend(s: Shop) -> DataFrame:
    daily = quality.dq_assessment_by_day(s.web_sessions, quality.session_rules())
    return quality.dq_trend(daily.filter(F.col("ds") <= WEB_DATE), WEB_DATE)


def _report(s: Shop) -> DataFrame:
    return quality.dq_daily_report(_assessed(s), quality.outlier_detect(s.dirty_orders), BIZDATE)


# ---- pipeline ---------------------------------------------------------------

def _pipeline_tables(s: Shop) -> dict[str, DataFrame]:
    return {**_dirty(s), "sales_orders": s.orders, "order_items": s.order_items, "products": s.products.join(
        s.dirty_products.select("product_id", F.col("cost").alias("dirty_cost")), "product_id").drop("cost").withColumnRenamed(
        "dirty_cost", "cost"), "web_sessions": s.on_day("shop_web_sessions", WEB_DATE), "page_views": s.on_day("shop_page_views", WEB_DATE),
        "web_orders": s.on_day("shop_purchases", WEB_DATE), "customers_now": s.customers, "customers_prev": s.shop_customers_prev}


def _daily_pipeline(s: Shop) -> DataFrame:
    return pipeline.daily_pipeline(s.spark, _pipeline_tables(s), staging_path(s.spark, "daily"), BIZDATE, WEB_DATE, AS_OF)


def _sla(s: Shop) -> DataFrame:
    """One run per order: its length follows from the key, one in 50 failed."""
    k = F.col("order_id")
    begin = F.col("order_date").cast("timestamp")
    jobs = s.orders.select(
        F.concat(F.lit("load_"), k.cast("string")).alias("job_name"), begin.alias("start_time"),
        F.timestamp_seconds(F.unix_seconds(begin) + 3000 + k % 7001).alias("end_time"),
        F.when(k % 50 == 0, "FAILED").otherwise("SUCCESS").alias("status"))
    return pipeline.job_sla_report(jobs)


def _day(s: Shop) -> tuple[layers.RunStore, pipeline.DayRun, str]:
    """One published run of the day that the queries below read; its expectations come from ``_expected``."""
    def make(s: Shop):
        root = staging_path(s.spark, "day")
        run = pipeline.run_day(s.spark, _pipeline_tables(s), root, BIZDATE, WEB_DATE, AS_OF, expectations=[e for e in _expected(s) if e.table in _DAY_TABLES])
        return layers.RunStore(s.spark, root), run, root
    return _once(s, "day", make)


_DAY_TABLES = ("daily_sales_summary", "customer_segments", "product_performance", "web_analytics_summary", "customer_changes",
               "data_quality_metrics", "dq_rules", "dq_assessment", "data_profile")


def _published(layer: str, table: str, *columns: str) -> Query:
    """Values of a table of the day, read back after the switch."""
    return _shop(lambda s: _day(s)[0].read(layer, table).select(*(columns or [c for c in schemas.schema_of(layer, table).fieldNames() if c != "ds"])))


def _expected(s: Shop) -> list[Expectation]:
    """What the caller of the run expects: seventeen sizes and twelve properties.  Sizes are those of the source files, which the tested tables don't give."""
    base = lambda t, where="true": s.base(t).filter(where).count()
    people, parts = base("customer"), base("part")
    doubled = base("customer", "c_custkey % 101 = 0")
    visits = s.base("events").select("user_id", F.to_date("ts")).distinct().count()
    rows = lambda t, n, kind="rows": Expectation(f"{t} has its rows", t, kind, expected=n)
    none = lambda t, what, c: Expectation(f"{t}: no {what}", t, "matching", c)
    return from_rows(as_rows(s.spark, [
        rows("customers", people), rows("products", parts), rows("orders", base("orders")), rows("order_items", base("lineitem")),
        rows("web_sessions", visits), rows("page_views", base("events", "event_type in ('view', 'click')")), rows("user_events", base("events")),
        rows("suppliers", base("supplier")), rows("daily_sales_summary", 1, "rows_at_least"), rows("customer_segments", people + doubled),
        rows("product_performance", parts), rows("web_analytics_summary", 1), rows("customer_changes", 1, "rows_at_least"),
        rows("data_quality_metrics", 3), rows("dq_rules", 6), rows("dq_assessment", 5), rows("data_profile", 3),
        none("customers", "empty customer_id", "customer_id is null"), none("orders", "empty order_id", "order_id is null"),
        none("order_items", "empty order_id", "order_id is null"), none("dirty_orders", "amount of zero or less", "total_amount <= 0"),
        Expectation("dirty_orders.customer_id is known", "dirty_orders", "reference", "customer_id", parent="dirty_customers.customer_id"),
        Expectation("order_items.order_id is in orders", "order_items", "reference", "order_id", parent="orders.order_id"),
        none("daily_sales_summary", "day without revenue", "total_revenue <= 0"),
        Expectation("customer_segments covers the customers", "customer_segments", "distinct", "customer_id", people),
        Expectation("customer_segments has known values", "customer_segments", "in_set", "segment_value", 0,
                    ("Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Cannot Lose", "Lost Customers")),
        Expectation("product_performance covers the products", "product_performance", "distinct", "product_id", parts),
        Expectation("dq_assessment has a PASS", "dq_assessment", "some", "status = 'PASS'", 1),
        Expectation("most mails are filled", "dirty_customers", "share", "email is not null", 0.95),
    ]))


def _assertions(s: Shop) -> DataFrame:
    """Layer tables and dirty inputs are scanned once each; of the day's tables only what their writes could not observe is looked up."""
    given = [e for e in _expected(s) if e.table not in _DAY_TABLES]
    under_test = {t: _layer(s, t) for t in schemas.ODS} | {"dirty_orders": s.dirty_orders, "dirty_customers": s.dirty_customers}
    return evaluate(under_test, given).unionByName(_day(s)[1].checks)


def _assertion_failures(s: Shop) -> DataFrame:
    given = [e for e in _expected(s) if e.table.startswith("dirty_")]
    return failing_rows({"dirty_orders": s.dirty_orders, "dirty_customers": s.dirty_customers}, given,
                        {"dirty_orders": "order_id", "dirty_customers": "customer_id"})


def _run_sla(s: Shop) -> DataFrame:
    """The log that the day's run wrote; how long a job took differs from run to run and is left out."""
    log = tables.read_table(s.spark, f"{_day(s)[2]}/ads/etl_job_status")
    return pipeline.job_sla_report(log).drop("duration_seconds").join(log.select("job_name", "job_type", "records_processed"), "job_name")


def _sla_stream(s: Shop) -> DataFrame:
    """The events of the day's run as a stream, one end left out and another run's start four hours later, so that its limits pass."""
    events = s.spark.read.schema(tables.EVENT).json(f"{_day(s)[2]}/ads/job_events")
    unended = events.filter(~((F.col("job_name") == "data_profile") & (F.col("event") == "SUCCESS")))
    later = events.groupBy().agg(F.max("at").alias("at")).select(
        F.lit("next").alias("run"), F.lit("dq_rules").alias("job_name"), F.lit("START").alias("event"), (F.col("at") + F.expr("interval 4 hours")).alias("at"))
    inbox, target, mark = (staging_path(s.spark, x) for x in ("inbox", "sla", "mark"))
    unended.unionByName(later, allowMissingColumns=True).coalesce(1).write.parquet(inbox)
    streams.finish(sla.sla_stream(streams.file_stream(s.spark, inbox, events.schema), target, mark))
    return s.spark.read.schema(sla.ROW).parquet(target).select("job_name", "status", "attempts", "sla_level", "alert_message")


def _tree_diff(s: Shop) -> DataFrame:
    """Two stored snapshots compared down their hash trees."""
    old, new = staging_path(s.spark, "snapshot"), staging_path(s.spark, "snapshot")
    columns = [c.split()[0] for c in _PERSON.split(", ")]
    snapshots.save_snapshot(s.shop_customers_prev.select(*columns), old)
    snapshots.save_snapshot(s.customers.select(*columns), new)
    return snapshots.snapshot_diff(s.spark, old, new, _PERSON)


# ---- text ---------------------------------------------------------------------

def _texts(s: Shop) -> DataFrame:
    return s.shop_text.repartition(shuffle_width(s.spark), "doc_id")


def _spread(table: DataFrame, key: str) -> DataFrame:
    """``table`` as it is read, unless its files give work to a part of the cores only."""
    spark = table.sparkSession
    return table if table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism else table.repartition(shuffle_width(spark), key)


def _string_utils(s: Shop, variant: str) -> DataFrame:
    name = f"string_utils_{variant}"
    sqlfuncs.register_string_utils(s.spark, variant, name)
    title = "clean" if variant == "v1" else "title_case"
    return s.dirty_customers.select(
        "customer_id", "email", "country",
        F.expr(f"{name}(concat('  ', first_name, '   jr. ', city), '{title.upper()}')").alias("title"),
        F.expr(f"{name}(country)").alias("by_default"), F.expr(f"{name}(country, 'no_such_mode')").alias("unknown_mode"),
        F.expr(f"{name}(email, 'mask_email')").alias("masked"), F.expr(f"{name}(country, 'Slug')").alias("slug"),
        F.expr(f"{name}(city, 'extract_numbers')").alias("digits"))


def _text_functions(s: Shop, variant: str) -> DataFrame:
    p = f"t{variant}_"
    sqlfuncs.register_text_functions(s.spark, variant, p)
    top = "" if variant == "v1" else ", 3"
    return _texts(s).selectExpr(
        "doc_id", f"{p}sentiment(text) sentiment", f"{p}keywords(text{top}) keywords",
        f"{p}similarity(text, concat(text, ' ', source)) self_similarity", f"{p}word_count(text) words",
        f"{p}language_detect(text) language", f"md5({p}clean(text, 'html')) cleaned")


def _clean(variant: str, mode: str = "all") -> Query:
    def run(s: Shop) -> DataFrame:
        df = text_jobs.corpus_clean(_texts(s), mode, variant)
        return df.select("doc_id", "source", "changed", F.length("clean_text").cast("bigint").alias("chars"), F.md5("clean_text").alias("digest"))
    return _shop(run)


def _shape(variant: str) -> Query:
    def run(s: Shop) -> DataFrame:
        df = text_jobs.text_shape(_texts(s), "doc_id", "text", variant)
        return df.select(*[F.md5(c).alias(c) if c in ("reverse", "upper", "lower", "extract_letters") else c for c in df.columns])
    return _shop(run)


def _similar(variant: str) -> Query:
    return _shop(lambda s: text_jobs.text_similarity_pairs(
        _texts(s), text_jobs.next_document_pairs(s.base("documents")), variant))


# ---- generated data -------------------------------------------------------------

def _ids(s: Shop) -> DataFrame:
    return s.base("customer").select(F.col("c_custkey").alias("i"))


def _generated(table: str) -> Query:
    return _shop(lambda s: synth.gen_all(_ids(s))[table])


def _gen_check(s: Shop) -> DataFrame:
    """Row counts of all generated tables and keys that do not resolve."""
    made = synth.gen_all(_ids(s))
    links = {"customers": None, "products": None, "orders": ("customer_id", "customers"), "order_items": ("order_id", "orders"),
             "web_sessions": None, "page_views": ("session_id", "web_sessions"), "user_events": ("session_id", "web_sessions")}
    parts = []
    for name, df in made.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        if links[name]:
            key, parent = links[name]
            lost = df.select(key).join(made[parent].select(key), key, "left_anti").agg(F.count("*")).scalar()
        else:
            lost = F.lit(0)
        parts.append(row.select("*", lost.cast("bigint").alias("orphans")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- incremental and streaming -----------------------------------------------------

def _incremental(s: Shop) -> DataFrame:
    """Target holds the events of the first ten days; the rest is loaded."""
    path = staging_path(s.spark, "events")
    events = s.base("events").select("event_id", "ts", "user_id", "event_type")
    events.filter(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")).write.parquet(path)
    fresh = features.newer_than_target(events, s.spark.read.parquet(path), "ts")
    fresh.write.mode("append").parquet(path)
    return s.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("ids"))


def _event_stream(s: Shop) -> DataFrame:
    return streams.file_stream(s.spark, s.sf_dir, s.base("events").schema, "events.parquet")


def _incremental_stream(s: Shop) -> DataFrame:
    """Two runs over the same files load each event once."""
    target, mark = staging_path(s.spark, "stream"), staging_path(s.spark, "mark")
    for _ in range(2):
        streams.finish(streams.incremental_load(_event_stream(s), target, mark))
    return s.spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("ids"))


def _dashboard_stream(s: Shop) -> DataFrame:
    target, mark = staging_path(s.spark, "feed"), staging_path(s.spark, "mark")
    stream = _event_stream(s).withColumn("ts", F.col("ts").cast("timestamp"))
    streams.finish(streams.dashboard_stream(stream, target, mark))
    return streams.dashboard_table(s.spark, target)


def _changes(s: Shop) -> DataFrame:
    return etl.snapshot_change_detect(s.customers, s.shop_customers_prev)


def _odd_customers(s: Shop) -> DataFrame:
    """Current customers with missing values, quotes and backslashes."""
    k = F.col("customer_id")
    return s.customers.withColumn("email", F.when(k % 37 != 0, F.col("email"))).withColumn("last_name", F.when(k % 43 != 0, F.col("last_name"))).withColumn(
        "first_name", F.when(k % 41 == 0, F.concat("first_name", F.lit(' "Q" \\x'))).otherwise(F.col("first_name")))


def _odd_changes(s: Shop) -> DataFrame:
    return etl.snapshot_change_detect(_odd_customers(s), s.shop_customers_prev, "rows", null_safe=True)


_PERSON = "customer_id bigint, first_name string, last_name string, email string"


def _cdc_stream(s: Shop) -> DataFrame:
    """Three change batches by the hash of their keys, merged into a store of 64 buckets."""
    inbox, base, mark = (staging_path(s.spark, x) for x in ("inbox", "base", "mark"))
    store = MergeStore(s.spark, base, _PERSON)
    store.create(s.shop_customers_prev)
    changes = stage(_odd_changes(s).withColumn("change_timestamp", F.lit(AS_OF).cast("timestamp")), "changes")
    for part in range(3):
        changes.filter(F.pmod(F.hash("customer_id"), F.lit(3)) == part).write.mode("append").parquet(inbox)
        stream = streams.file_stream(s.spark, inbox, changes.schema)
        streams.finish(streams.cdc_stream(stream, store, mark))
    return store.read()


def queries() -> dict[str, Query]:
    S = _shop
    q: dict[str, Query] = {
        # sources, sinks, table maintenance
        "csv_ingest": S(_csv_ingest), "malformed_row_quarantine": S(_quarantine), "static_partition_load": S(_static_partition),
        "literal_rows": S(_literal_rows), "insert_overwrite_partition": S(_overwrite_partition),
        "insert_append_partition": S(_append_partition), "insert_overwrite_table": S(_overwrite_table),
        "partition_retention": S(_retention), "table_row_counts": S(_row_counts), "ods_typed_view": S(_typed_view),
        "layered_tables": S(_layered),
        # basic queries
        "filter_project_sort": S(lambda s: basic.customers_in_country(s.customers, "NATION_2")),
        "group_count": S(lambda s: basic.customers_per_country(s.customers)),
        "days_since_launch": S(lambda s: basic.days_since_launch(s.products, AS_OF)),
        "partition_filter": S(lambda s: basic.orders_in_partition(_orders_by_day(s), BIZDATE)), "run_date_orders": S(_run_dates),
        "ci_substring_match": S(lambda s: basic.brands_like(s.products, "BRAND#1")),
        "date_parts": S(lambda s: basic.order_date_parts(s.orders_since(BIZDATE), BIZDATE)),
        "profit_margin": S(lambda s: basic.profit_margins(s.products)),
        "exists_semi_join": S(lambda s: basic.customers_with_orders(s.prospects, s.orders)),
        "limit_offset_page": S(lambda s: basic.product_page(s.products, 2)),
        "null_cleanup": S(lambda s: basic.fill_missing(s.dirty_customers)),
        # joins and analytics
        "orders_with_customer": S(lambda s: analytics.orders_with_customer(s.orders_since(BIZDATE), s.customers, BIZDATE)),
        "customer_order_summary": S(lambda s: analytics.customer_order_summary(s.prospects, s.orders)),
        "order_line_detail": S(lambda s: analytics.order_line_detail(s.orders_since(BIZDATE), s.customers, s.order_items, s.products, BIZDATE)),
        "customer_spend_ranks": S(lambda s: analytics.customer_spend_ranks(s.prospects, s.orders)),
        "running_and_moving": S(lambda s: analytics.running_and_moving(s.orders_since(BIZDATE), BIZDATE)),
        "product_sales_report": S(lambda s: analytics.product_sales_report(s.catalog, s.order_items, s.orders)),
        "customer_segment_rules": S(lambda s: analytics.customer_segment_rules(s.prospects, s.orders, AS_OF)),
        "monthly_trends": S(lambda s: analytics.monthly_trends(s.orders_since("19960101"), "19960101")),
        "same_city_pairs": S(lambda s: analytics.same_city_pairs(s.customers)),
        "price_band_crosstab": S(lambda s: analytics.price_band_crosstab(s.products)),
        # layered ETL
        "daily_sales_summary": S(lambda s: etl.daily_sales_summary(s.month_of_orders(BIZDATE), s.order_items, s.products, BIZDATE)),
        "top_category": S(lambda s: etl.top_category(s.order_items, s.products, s.month_of_orders(BIZDATE), BIZDATE)),
        "top_product": S(lambda s: etl.top_product(s.order_items, s.month_of_orders(BIZDATE), BIZDATE)),
        "rfm_scores": S(lambda s: etl.rfm_scores(s.prospects, s.orders, AS_OF)),
        "rfm_segments": S(lambda s: etl.customer_segments(s.prospects, s.orders, AS_OF, "v1")),
        "value_segments": S(lambda s: etl.customer_segments(s.prospects, s.orders, AS_OF, "v2")),
        "product_performance": S(lambda s: etl.product_performance(s.catalog, s.order_items, s.orders)),
        "web_analytics_summary": S(lambda s: etl.web_analytics_summary(*_web_day(s), WEB_DATE)),
        "web_analytics_summary_by_user": S(lambda s: etl.web_analytics_summary(*_web_day(s), WEB_DATE, keys=("date", "user_id"))),
        "top_traffic_source": S(lambda s: etl.top_traffic_source(_web_day(s)[0], WEB_DATE)),
        "page_rank_by_views": S(lambda s: etl.page_rank_by_views(_web_day(s)[1], WEB_DATE)),
        "session_conversion": S(lambda s: etl.session_conversion(_web_day(s)[0], _web_day(s)[2], WEB_DATE)),
        "session_conversion_by_user": S(lambda s: etl.session_conversion(
            _web_day(s)[0], _web_day(s)[2], WEB_DATE, keys=("date", "user_id"))),
        "snapshot_change_detect": S(_changes), "snapshot_tree_diff": S(_tree_diff),
        "snapshot_change_detect_v2": S(lambda s: etl.snapshot_change_detect(s.customers, s.shop_customers_prev, "v2")),
        "snapshot_change_null_safe": S(lambda s: etl.snapshot_change_detect(
            s.customers.withColumn("email", F.when(F.col("customer_id") % 37 != 0, F.col("email"))),
            s.customers, null_safe=True).select("customer_id", "change_type")),
        "snapshot_self_diff": S(lambda s: etl.snapshot_change_detect(s.customers, s.customers, "v2")),
        "dq_metrics_v1": S(lambda s: etl.dq_metrics(s.dirty_customers, s.dirty_orders, s.dirty_products, BIZDATE, "v1")),
        "dq_metrics_v2": S(lambda s: etl.dq_metrics(s.dirty_customers, s.dirty_orders, s.dirty_products, BIZDATE, "v2")),
        "etl_job_status_log": S(_job_status),
        # data quality
        "dq_rules": S(_rule_catalog),
        "dq_null_check": S(lambda s: quality.dq_check("DQ001", _dirty(s))),
        "dq_format_check": S(lambda s: quality.dq_check("DQ002", _dirty(s))),
        "dq_uniqueness_check": S(lambda s: quality.dq_check("DQ003", _dirty(s))),
        "dq_range_check": S(lambda s: quality.dq_check("DQ004", _dirty(s))),
        "dq_cross_column_check": S(lambda s: quality.dq_check("DQ005", _dirty(s))),
        "dq_referential_check": S(lambda s: quality.dq_check("DQ006", _dirty(s))),
        "dq_assessment": S(lambda s: _assessed(s, "v1")), "dq_assessment_v2": S(lambda s: _assessed(s, "v2")),
        "data_profile": S(lambda s: _profile(s, "v1")), "data_profile_v2": S(lambda s: _profile(s, "v2")),
        "cleanse_email": S(lambda s: s.dirty_customers.select("customer_id", "email", quality.cleanse_email().alias("email_clean"))),
        "cleanse_phone": S(lambda s: s.dirty_customers.select("customer_id", "phone", quality.cleanse_phone().alias("phone_clean"))),
        "standardize_country": S(lambda s: s.dirty_customers.groupBy(
            "country", quality.standardize_country().alias("country_clean")).agg(F.count("*").alias("customers"))),
        "customers_clean": S(lambda s: quality.customers_clean(s.dirty_customers)),
        "outlier_stats": S(lambda s: quality.outlier_stats(s.dirty_orders)),
        "outlier_detect": S(lambda s: quality.outlier_detect(s.dirty_orders)),
        "dq_score_by_table": S(lambda s: quality.dq_score_by_table(_assessed(s), BIZDATE)),
        "dq_trend_7d": S(_day_trend),
        "dq_critical_issues": S(lambda s: quality.dq_critical_issues(_assessed(s), BIZDATE)),
        "dq_daily_report": S(_report),
        "dq_alerts": S(lambda s: quality.dq_alerts(_assessed(s), BIZDATE, min_rate=0.5)),
        # validation suite
        "tables_nonempty": S(lambda s: validation.tables_nonempty(s.customers, s.products, s.orders)),
        "count_validation": S(lambda s: validation.count_validation(s.customers, s.products, s.orders, s.order_items)),
        "null_key_check": S(lambda s: validation.null_key_check(s.customers, s.products, s.orders)),
        "email_validation": S(lambda s: validation.email_validation(s.dirty_customers)),
        "price_validation": S(lambda s: validation.price_validation(s.dirty_products)),
        "amount_validation": S(lambda s: validation.amount_validation(s.dirty_orders)),
        "orphan_orders": S(lambda s: validation.orphan_orders(s.dirty_orders, s.customers)),
        "orphan_order_items": S(lambda s: validation.orphan_order_items(
            s.loose_items, s.orders, s.products)),
        "orphan_order_items_v2": S(lambda s: validation.orphan_order_items(s.loose_items, s.orders, s.products, "v2")),
        "order_total_verification": S(lambda s: validation.order_total_verification(s.orders, s.order_items)),
        "date_range_validation": S(lambda s: validation.date_range_validation(s.customers, s.orders)),
        "partition_prune_count": S(lambda s: validation.partition_prune_count(_orders_by_day(s), BIZDATE)),
        "in_list_distinct": S(lambda s: validation.in_list_distinct(s.orders, [1, 2, 3])),
        "aggregation_consistency": S(lambda s: validation.aggregation_consistency(s.orders, s.order_items)),
        "distribution_pct": S(lambda s: validation.distribution_pct(s.customers)),
        "category_price_stats": S(lambda s: validation.category_price_stats(s.products)),
        "health_summary": S(lambda s: validation.health_summary(s.dirty_customers, s.products, s.dirty_orders)),
        # text
        "corpus_sentiment": S(lambda s: text_jobs.corpus_sentiment(_texts(s), "v1")),
        "corpus_sentiment_v2": S(lambda s: text_jobs.corpus_sentiment(_texts(s), "v2")),
        "sentiment_by_language": S(lambda s: text_jobs.sentiment_by_language(_texts(s), "v1")),
        "corpus_keywords": S(lambda s: text_jobs.corpus_keywords(_texts(s), "v1")),
        "corpus_keywords_v2": S(lambda s: text_jobs.corpus_keywords(_texts(s), "v2", 3)),
        "text_similarity_pairs": _similar("v1"), "text_similarity_pairs_v2": _similar("v2"),
        "text_similarity_join": S(lambda s: text_jobs.text_similarity_join(_spread(s.base("documents"), "doc_id"))),
        "corpus_word_count": S(lambda s: text_jobs.corpus_word_count(_texts(s), "v1")),
        "corpus_word_count_v2": S(lambda s: text_jobs.corpus_word_count(_texts(s), "v2")),
        "corpus_language_profile": S(lambda s: text_jobs.corpus_language_profile(_texts(s), "v1")),
        "corpus_language_profile_v2": S(lambda s: text_jobs.corpus_language_profile(_texts(s), "v2")),
        "corpus_clean": _clean("v1"), "corpus_clean_v2": _clean("v2"), "corpus_clean_html": _clean("v1", "html"),
        "clean_audit": S(lambda s: text_jobs.clean_audit(_texts(s), "v1")),
        "name_standardize_job": S(lambda s: text_jobs.name_standardize(s.products, "product_id", "product_name", "v1")),
        "name_standardize_job_v2": S(lambda s: text_jobs.name_standardize(s.products, "product_id", "product_name", "v2")),
        "pii_mask_job": S(lambda s: text_jobs.pii_mask(s.dirty_customers, "customer_id", "country", variant="v1")),
        "pii_mask_job_v2": S(lambda s: text_jobs.pii_mask(s.dirty_customers, "customer_id", "country", variant="v2")),
        "pii_mask_counts": S(lambda s: text_jobs.pii_mask_counts(
            text_jobs.pii_mask(s.dirty_customers, "customer_id", "country"), "country")),
        "pii_mask_text": S(lambda s: text_jobs.mask_text(_texts(s)).select(
            "doc_id", "changed", F.md5("masked_text").alias("digest"))),
        "pii_mask_text_left": S(lambda s: text_jobs.unmasked_left(text_jobs.mask_text(_texts(s)))),
        "contact_validation_report": S(lambda s: text_jobs.contact_validation(s.dirty_customers, "country")),
        "text_shape_job": _shape("v1"), "text_shape_job_v2": _shape("v2"),
        "text_shape_summary": S(lambda s: text_jobs.text_shape_summary(_texts(s), "text", "source")),
        "string_utils_sql": S(lambda s: _string_utils(s, "v1")), "string_utils_sql_v2": S(lambda s: _string_utils(s, "v2")),
        "text_functions_sql": S(lambda s: _text_functions(s, "v1")),
        "text_functions_sql_v2": S(lambda s: _text_functions(s, "v2")),
        # generated data, sized by the customer table
        "gen_customers": _generated("customers"), "gen_products": _generated("products"), "gen_orders": _generated("orders"),
        "gen_order_items": _generated("order_items"), "gen_web_sessions": _generated("web_sessions"),
        "gen_page_views": _generated("page_views"), "gen_user_events": _generated("user_events"),
        "gen_all_consistent": S(_gen_check),
        # pipeline
        "daily_pipeline": S(_daily_pipeline), "job_sla_report": S(_sla), "table_assertions": S(_assertions),
        "table_assertion_failures": S(_assertion_failures), "daily_run_sla": S(_run_sla), "daily_run_sla_stream": S(_sla_stream),
        "daily_run_sales": _published("dwd", "daily_sales_summary"),
        "daily_run_segments": _published("dwd", "customer_segments", "customer_id", "segment_value", "total_orders", "segment_score"),
        "daily_run_performance": _published("dwd", "product_performance", "product_id", "total_quantity_sold", "orders_count", "performance_rank"),
        "daily_run_web": _published("ads", "web_analytics_summary"), "daily_run_rules": _published("ads", "dq_rules", "rule_id", "table_name", "rule_type", "severity"),
        "daily_run_metrics": _published("ads", "data_quality_metrics", "table_name", "metric_name", "metric_value", "threshold_value", "status"),
        "daily_run_profile": _published("ads", "data_profile", "table_name", "column_name", "total_records", "null_count", "distinct_count", "avg_value"),
        "daily_run_outliers": _published("ads", "data_outliers", "record_id", "outlier_type", "z_score", "percentile_rank", "severity"),
        "daily_run_assessment": _published("ads", "dq_assessment", "rule_id", "failed_records", "failure_rate", "status", "ds"),
        "daily_run_changes": _published("ads", "customer_changes", "customer_id", "change_type", "old_data", "new_data", "processed"),
        "daily_run_report": _published("ads", "dq_daily_report", "report_date", "total_rules_executed", "critical_issues", "outliers_detected", "records_processed"),
        # features and increments
        "top10_customers": S(lambda s: features.top_customers(s.customers, s.orders)),
        "aov_by_country": S(lambda s: features.aov_by_country(s.customers, s.orders)),
        "inactive_customers_30d": S(lambda s: features.inactive_customers(s.prospects, s.orders, AS_OF)),
        "top_products_per_category": S(lambda s: features.top_products_per_category(s.products, s.order_items)),
        "underperforming_products": S(lambda s: features.underperforming_products(s.catalog, s.order_items, s.orders)),
        "incremental_load": S(_incremental), "incremental_load_stream": S(_incremental_stream),
        "dashboard_feed": S(lambda s: features.dashboard_feed(s.base("events"))),
        "dashboard_feed_stream": S(_dashboard_stream),
        "cdc_apply": S(lambda s: features.cdc_apply(s.shop_customers_prev, _odd_changes(s))), "cdc_apply_stream": S(_cdc_stream),
        "customer_features": S(lambda s: features.customer_features(s.prospects, s.orders, s.order_items, AS_OF)),
        "copurchase_features": S(lambda s: features.copurchase_pairs(s.order_items)),
        "churn_dataset": S(lambda s: features.churn_dataset(s.customers, s.orders, CUTOFF)),
    }
    if llm_queries:
        q |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return {k: _with_folder(f) for k, f in q.items()}


def oracle_sql() -> dict[str, str]:
    sql = all_oracles()
    if llm_queries:
        sql |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
