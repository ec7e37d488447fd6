"""Physical plans stay distributed: pruning, pushdown, no nested loops."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stallkeeper.plans import basic, etl
from stallkeeper.sources.adapters import BIZDATE
from tests.conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


KEYS = ["orders_with_customer", "customer_order_summary", "order_line_detail", "customer_spend_ranks", "running_and_moving",
        "product_sales_report", "same_city_pairs", "daily_sales_summary", "product_performance", "web_analytics_summary",
        "snapshot_change_detect", "dq_assessment_v2", "outlier_detect", "date_range_validation", "aggregation_consistency",
        "distribution_pct", "corpus_keywords", "text_similarity_pairs_v2", "text_similarity_join", "copurchase_features",
        "customer_features", "churn_dataset", "gen_all_consistent"]


@pytest.mark.parametrize("key", KEYS)
def test_no_nested_loops_and_no_python(spark, key):
    text = plan(entry.queries()[key](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas", text)


def test_plain_window_only_over_summaries(spark, shop):
    """Windows without partition keys sit above a grouped aggregate."""
    from stallkeeper.plans import analytics

    text = plan(analytics.customer_spend_ranks(shop.prospects, shop.orders, block_rows=100))
    singles = re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*?(\w+Aggregate|\w+)\b", text)
    assert singles and all("Aggregate" in s for s in singles)


def test_month_filter_reaches_the_scan(spark, shop):
    text = plan(basic.orders_in_partition(shop.month_of_orders(BIZDATE), BIZDATE))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


@pytest.mark.parametrize("key,column", [
    ("date_parts", "o_orderdate"), ("orders_with_customer", "o_orderdate"), ("order_line_detail", "o_orderdate"), ("monthly_trends", "o_orderdate"),
    ("web_analytics_summary", "ts"), ("top_traffic_source", "ts"), ("session_conversion", "ts")])
def test_date_bounds_reach_the_scan(spark, key, column):
    text = plan(entry.queries()[key](spark, SF_DIR))
    scans = re.findall(r"FileScan parquet[^\n]*/(?:orders|events)\.parquet[^\n]*", text)
    assert scans and all(f"GreaterThanOrEqual({column}" in s for s in scans)


@pytest.mark.parametrize("key", ["customer_spend_ranks", "same_city_pairs", "outlier_detect", "product_performance", "page_rank_by_views"])
def test_global_order_never_gathers_rows(spark, key):
    """In registered queries only grouped summaries meet in one partition."""
    text = plan(entry.queries()[key](spark, SF_DIR))
    for below in re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*?\+- [*() 0-9]*(\w+)", text):
        assert "Aggregate" in below or below in ("Project", "Filter"), below


def test_scan_reads_needed_columns_only(spark, shop):
    text = plan(etl.top_product(shop.order_items, shop.month_of_orders(BIZDATE), BIZDATE))
    assert "l_shipdate" not in text and "o_totalprice" not in text and "l_tax" not in text


def test_assessment_scans_each_table_once(spark, folder):
    from stallkeeper.operators import rules
    from stallkeeper.plans import quality

    paths = {n: folder(n) for n in ("customers", "orders", "products")}
    spark.createDataFrame([(1, "a@b.co")], "customer_id long, email string").write.parquet(paths["customers"])
    spark.createDataFrame([(1, 2.0)], "customer_id long, total_amount double").write.parquet(paths["orders"])
    spark.createDataFrame([(2.0, 1.0)], "price double, cost double").write.parquet(paths["products"])
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    text = plan(quality.dq_assessment(tables, "20240115", "v2"))
    # customers is read for its own rules and as the parent of orders
    assert text.count("FileScan") == 4 and len(rules.active_rules("v2")) == 6


def test_per_group_top_k_is_trimmed_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["top_products_per_category"](spark, SF_DIR))


def test_hot_customer_is_reduced_before_the_join(spark, shop):
    from stallkeeper.plans import analytics

    hot = shop.orders.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(7)).otherwise(F.col("customer_id")))
    text = plan(analytics.customer_order_summary(shop.customers, hot))
    assert "partial_sum" in text
