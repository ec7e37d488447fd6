"""Partitioned layers, dynamic pruning and the switch that publishes a run."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stallkeeper.sources import layers
from stallkeeper.sources.schemas import LAYERS, schema_of
from tests.conftest import SF_DIR
from tests.test_plans import plan


def test_layers_are_created_empty(spark, folder):
    root = folder()
    made = layers.create_layers(spark, root)
    assert len(made) == sum(map(len, LAYERS.values()))
    for layer, table, _ in made[::4]:
        df = layers.read_layer(spark, root, layer, table)
        assert df.count() == 0 and df.columns == schema_of(layer, table).names


def test_load_counts_rows_and_replaces_its_days_only(spark, folder):
    root = folder()
    rows = lambda day, n: spark.range(n).select(F.col("id").alias("order_id"), F.lit(day).alias("ds"))
    assert layers.load_layer(rows("20240101", 5).union(rows("20240102", 3)), root, "ods", "orders") == 8
    assert layers.load_layer(rows("20240102", 4), root, "ods", "orders") == 4
    got = {r["ds"]: r["count"] for r in layers.read_layer(spark, root, "ods", "orders").groupBy("ds").count().collect()}
    assert got == {"20240101": 5, "20240102": 4}


@pytest.mark.parametrize("key", ["partition_filter", "partition_prune_count"])
def test_one_day_is_a_partition_filter(spark, key):
    text = plan(entry.queries()[key](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[isnotnull\(ds#\d+\), \(ds#\d+ = 19960901\)\]", text)


def test_run_dates_prune_partitions_while_the_query_runs(spark):
    df = entry.queries()["run_date_orders"](spark, SF_DIR)
    text = plan(df)
    assert "dynamicpruning" in text
    df.collect()
    read = re.search(r"number of partitions read: (\d+)", df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    assert read is None or int(read.group(1)) <= 4


def day(spark, text, n):
    return spark.range(n).select(F.lit(text).alias("sales_date"), F.col("id").alias("total_orders"), *[
        F.lit(None).alias(c) for c in ("total_revenue", "total_customers", "avg_order_value", "top_category", "top_product_id")], F.lit(text).alias("ds"))


def test_a_run_is_seen_when_it_is_published(spark, folder):
    store = layers.RunStore(spark, folder())
    assert store.read("dwd", "daily_sales_summary").count() == 0
    assert store.write(day(spark, "20240101", 3), "dwd", "daily_sales_summary", "a")["rows"] == 3
    assert store.read("dwd", "daily_sales_summary").count() == 0  # written, not published
    store.publish("a", [("dwd", "daily_sales_summary", "20240101")])
    assert store.read("dwd", "daily_sales_summary").count() == 3
    store.write(day(spark, "20240101", 5), "dwd", "daily_sales_summary", "b")
    store.write(day(spark, "20240102", 2), "dwd", "daily_sales_summary", "b")  # overwrites folders of the run by day only
    assert store.read("dwd", "daily_sales_summary").count() == 3
    store.publish("b", [("dwd", "daily_sales_summary", "20240102")])
    assert {r["ds"]: r["count"] for r in store.read("dwd", "daily_sales_summary").groupBy("ds").count().collect()} == {"20240101": 3, "20240102": 2}
    store.publish("b", [("dwd", "daily_sales_summary", "20240101")])
    assert store.read("dwd", "daily_sales_summary").count() == 7
    text = plan(store.read("dwd", "daily_sales_summary").filter("ds = '20240102'"))
    assert re.search(r"PartitionFilters: \[[^\]]*ds", text)
