"""Steps that must not grow faster than their input: dealt joins, nothing moved twice."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from stallkeeper.plans import etl, pipeline
from stallkeeper.plans.analytics import product_order_facts
from stallkeeper.sources.adapters import BIZDATE, Shop
from tests.test_plans import plan

LINES = [(o, p, q) for o, p, q in [(1, 1, 1), (1, 1, 2), (1, 2, 1), (2, 1, 1), (3, 1, 4), (4, 2, 1), (9, 2, 1), (9, 3, 1), (None, 3, 2), (5, 4, 1), (6, 4, 1)]]
ORDERS = [(1, 10), (1, 11), (2, 11), (3, None), (4, 12), (5, 10), (6, 10), (None, 13)]


def facts(spark, **how):
    items = spark.createDataFrame(LINES, "order_id long, product_id long, quantity long").withColumns(
        {c: F.col("quantity").cast("decimal(18,2)") for c in ("unit_price", "line_total")})
    return product_order_facts(items, spark.createDataFrame(ORDERS, "order_id long, customer_id long"), **how)


def test_product_facts_equal_brute_force(spark):
    buyer = defaultdict(lambda: None)
    for o, c in ORDERS:
        buyer[o] = max((x for x in (buyer[o], c) if x is not None), default=None)
    want = {}
    for p in {p for _, p, _ in LINES}:
        known = {o for o, q, _ in LINES if q == p and o is not None and o in {x for x, _ in ORDERS}}
        want[p] = (sum(n for _, q, n in LINES if q == p), len(known), len({buyer[o] for o in known} - {None}))
    for rows in (1, 3, 1_000_000):
        got = {r["product_id"]: (r["quantity"], r["orders_count"], r["unique_customers"]) for r in facts(spark, task_rows=rows).collect()}
        assert got == want


def test_product_facts_are_dealt_by_their_rows(spark):
    text = plan(facts(spark, task_rows=1))
    for keys in ("product_id#\\d+L, order_id#\\d+L", "order_id#\\d+L", "product_id#\\d+L, customer_id#\\d+L"):
        assert re.search(rf"hashpartitioning\({keys}, {len(LINES)}\), REPARTITION_BY_NUM", text)


def test_sales_summary_reads_the_lines_once(spark, shop):
    text = plan(etl.daily_sales_summary(shop.month_of_orders(BIZDATE), shop.order_items, shop.products, BIZDATE))
    assert "l_orderkey" not in text and "lineitem" not in text


def test_lines_are_not_kept_in_the_daily_run():
    assert "order_items" not in pipeline.SHARED
