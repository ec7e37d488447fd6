"""Jobs on raw tables as loaded: text dates, double amounts, hot keys."""

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators import rules
from stallkeeper.plans import analytics, etl, pipeline, quality
from stallkeeper.sources import tables
from stallkeeper.sources.layers import RunStore
from tests.test_tables import write_lines

ORDERS = ["order_id,customer_id,order_date,order_status,total_amount,shipping_cost,payment_method,shipping_address",
          'N1,K1,2022-05-02 07:05:00,completed,61.5,4.25,invoice,"8 Mill Rd, Ely"', "N2,K2,2022-05-02 19:40:00,completed,33.25,0,invoice,x",
          "N3,K1,2022-05-03 12:00:00,shipped,12,1.5,invoice,x", "N4,K9,2022-05-04 06:30:00,completed,-7,0,invoice,x"]
CUSTOMERS = ["customer_id,first_name,last_name,email,phone,registration_date,country,city,age_group",
             "K1,Ida,Voss,ida@voss.net,+1-555-7788,2021-03-04,USA,Boston Bay,35-44", "K2,Tim,Orr,bad,,2021-03-05,uk,leeds,45-54",
             "K3,Zoe,Hill,,1,2021-03-06,USA,Boston Bay,18-24"]
ITEMS = ["order_item_id,order_id,product_id,quantity,unit_price,discount_amount,line_total",
         "J1,N1,A1,2,24,0,48", "J2,N2,A2,1,33.25,0,33.25", "J3,N7,A1,1,24,0,24"]
PRODUCTS = ["product_id,product_name,category,sub_category,brand,price,cost,supplier_id,launch_date",
            "A1,Kettle,Kitchen,Metal,Brewly,24,9,W1,2020-02-11", "A2,Scarf,Wear,Wool,Knitto,33.25,33.5,W2,2020-09-30"]
SESSIONS = ["session_id,user_id,session_start,session_end,page_views,session_duration_seconds,traffic_source,device_type,browser,country",
            "T1,W1,2022-05-02 18:00:00,2022-05-02 18:07:10,5,430,search,desktop,opera,FIN", "T2,W2,2022-05-02 20:01:00,2022-05-02 20:01:30,1,30,mail,mobile,opera,FIN"]
VIEWS = ["page_view_id,session_id,user_id,page_url,page_title,timestamp,time_on_page_seconds,referrer_url,exit_page",
         "G1,T1,W1,/start,Start,2022-05-02 18:00:00,90,mail,false", "G2,T1,W1,/basket,Basket,2022-05-02 18:03:00,45,/start,true"]


@pytest.fixture(scope="module")
def raw(spark):
    from stallkeeper.session import staging_path

    out = {}
    for name, lines in {"orders": ORDERS, "customers": CUSTOMERS, "order_items": ITEMS, "products": PRODUCTS,
                        "web_sessions": SESSIONS, "page_views": VIEWS}.items():
        path = staging_path(spark, name)
        write_lines(spark, path, lines)
        df = tables.csv_ingest(spark, path, name)
        out[name] = df if name in ("customers", "products") else df.withColumn("ds", F.lit("20220502"))
    return out


def test_sales_and_segments_from_text_dates(raw):
    sales = {r["sales_date"]: r["total_revenue"] for r in etl.daily_sales_summary(raw["orders"], raw["order_items"], raw["products"], "20220502").collect()}
    assert sales == pytest.approx({"2022-05-02": 94.75, "2022-05-04": -7.0})
    seg = {r["customer_id"]: r["days_since_last_order"] for r in etl.value_segments(raw["customers"], raw["orders"], "2022-05-07").collect()}
    assert seg == {"K1": 4, "K2": 5, "K3": None}
    rank = {r["customer_id"]: r["spending_rank"] for r in analytics.customer_spend_ranks(raw["customers"], raw["orders"]).collect()}
    assert rank == {"K1": 1, "K2": 2, "K3": 3}
    perf = {r["product_id"]: (r["total_profit"], r["orders_count"]) for r in etl.product_performance(raw["products"], raw["order_items"], raw["orders"]).collect()}
    assert perf["A1"] == (pytest.approx(45.0), 1) and perf["A2"] == (pytest.approx(-0.25), 1)


def test_daily_run_twice_gives_the_same_tables(spark, raw, folder):
    root = folder()
    run = {**raw, "sales_orders": raw["orders"], "web_orders": raw["orders"]}
    counts = [sorted(map(tuple, pipeline.daily_pipeline(spark, run, root, "20220502", "20220502", "2022-05-07", "v2").collect())) for _ in range(2)]
    assert counts[0] == counts[1]
    assert {r[1]: r[3] for r in counts[0]} == {
        "dq_assessment": 6, "data_outliers": 0, "customer_segments": 3, "product_performance": 2, "web_analytics_summary": 1, "daily_sales_summary": 2,
        "dq_daily_report": 1, "dq_rules": 6, "data_quality_metrics": 3, "data_profile": 3}
    store = RunStore(spark, root)
    report = store.read("ads", "dq_daily_report").collect()
    assert len(report) == 1 and report[0]["critical_issues"] == 2 and report[0]["top_issue_table"] == "orders"
    log = tables.read_table(spark, f"{root}/ads/etl_job_status")
    assert log.count() == 20 and log.filter("status <> 'SUCCESS' or end_time < start_time").count() == 0
    assert {r["job_name"]: r["records_processed"] for r in log.collect()} == {r[1]: r[3] for r in counts[0]}
    web = store.read("ads", "web_analytics_summary").first()
    assert (web["bounce_rate"], web["conversion_rate"], web["top_page"], web["top_traffic_source"]) == (50.0, 100.0, "/basket", "mail")


def test_failed_run_is_logged_and_leaves_the_old_day(spark, raw, folder):
    root = folder()
    run = {**raw, "sales_orders": raw["orders"], "web_orders": raw["orders"]}
    pipeline.daily_pipeline(spark, run, root, "20220502", "20220502", "2022-05-07", "v2")
    store = RunStore(spark, root)
    before = {t: sorted(map(str, store.read("dwd", t).collect())) for t in ("customer_segments", "product_performance", "daily_sales_summary")}
    broken = {**run, "customers": raw["customers"].limit(1), "page_views": raw["page_views"].drop("page_url")}
    with pytest.raises(Exception, match="page_url"):
        pipeline.daily_pipeline(spark, broken, root, "20220502", "20220502", "2022-05-07", "v2")
    assert before == {t: sorted(map(str, store.read("dwd", t).collect())) for t in before}
    log = tables.read_table(spark, f"{root}/ads/etl_job_status").filter("status = 'FAILED'").collect()
    assert [r["job_name"] for r in log] == ["web_analytics_summary"] * 2  # one retry
    assert all("page_url" in r["error_message"] and r["records_processed"] == 0 for r in log)


def test_clean_and_profile(raw):
    flags = {r["customer_id"]: r["cleansing_flags"] for r in quality.customers_clean(raw["customers"]).collect()}
    assert flags == {"K1": "PHONE_FORMATTED", "K2": "EMAIL_INVALID|CITY_FORMATTED", "K3": "PHONE_FORMATTED"}
    prof = {r["column_name"]: (r["null_count"], r["distinct_count"]) for r in quality.shop_profile(raw["customers"], raw["orders"]).collect()}
    assert prof == {"customer_id": (0, 3), "email": (1, 2), "total_amount": (0, 4)}


def test_hot_customer_gives_the_same_totals(spark):
    """One customer holds a third of the orders and many repeat product lines."""
    orders = spark.range(3000).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
        F.lit("2024-01-15").alias("order_date"), F.lit(1.0).alias("total_amount"), F.lit("d").alias("ds"))
    people = spark.range(3000).select(F.col("id").alias("customer_id"), F.lit("f").alias("first_name"), F.lit("l").alias("last_name"))
    top = analytics.customer_spend_ranks(people, orders, block_rows=200).filter("spending_rank_with_ties <= 2")
    rows = {r["customer_id"]: (r["total_spent"], r["dense_spending_rank"]) for r in top.collect()}
    assert rows[0] == (1000.0, 1) and len(rows) == 2001 and set(v for k, v in rows.items() if k) == {(1.0, 2)}
    got = rules.assess({"orders": orders, "customers": people.filter("customer_id > 0"), "products": None}, [
        r for r in rules.standard_rules("v2") if r.table == "orders"]).filter("rule_id = 'DQ006'").first()
    assert (got["total_records"], got["failed_records"]) == (3000, 1000)
