"""Loading the large layer tables: narrow rows, dealt by number, the lines beside hashed orders."""

import re

from pyspark.sql import functions as F

from stallkeeper.sources import layers
from stallkeeper.sources.adapters import Shop
from tests.test_plans import plan


def test_layer_rows_are_dealt_by_number_and_become_text_last(spark, folder, monkeypatch):
    seen = []
    write = layers._write
    monkeypatch.setattr(layers, "_write", lambda df, *a: (seen.append(plan(df)), write(df, *a)))
    rows = spark.range(100).select(F.col("id").alias("order_id"), F.when(F.col("id") > 3, F.lit("20240101")).alias("ds"))
    root = folder()
    assert layers.load_layer(rows, root, "ods", "orders", 5_000_000, "order_id") == 100
    assert layers.load_layer(rows, folder(), "ods", "orders") == 100
    assert re.search(r"rangepartitioning\(ds#\d+ ASC NULLS FIRST, order_id#\d+L ASC NULLS FIRST, 5\)", seen[0])
    for text in seen:
        assert text.index("cast(order_id#") < text.index("Exchange")
    assert layers.read_layer(spark, root, "ods", "orders").filter("ds is null").count() == 4


def test_lines_stream_past_hashed_orders_and_equal_the_view(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, 7, "F", 10.0, f"1996-0{1 + i % 3}-05", "1") for i in range(1, 30)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, d string, o_orderpriority string").withColumn(
        "o_orderdate", F.col("d").cast("timestamp")).drop("d").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i % 32, i % 5, i % 7, 10.0 + i, 0.05) for i in range(90)] + [(None, 1, 1, None, 0.1)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    s = Shop(spark, str(tmp_path))
    months = s.orders.select("order_id", "ds")
    want = s.order_items.join(months, "order_id", "left")
    moved = s.base("lineitem").join(months, F.col("l_orderkey") == F.col("order_id"), "left").drop("order_id")
    got = s.items_of(moved, "ds")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
