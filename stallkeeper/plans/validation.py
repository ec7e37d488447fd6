"""Validation suite: counts, keys, references and consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import count_if, dbl, mean
from ..functions.strings import EMAIL_PATTERN

# Notes of two checks.
NOTE_PRUNING = "Should execute quickly with partition pruning"
NOTE_LOOKUP = "Should execute quickly with proper indexing"


def _named(test: str, df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(F.lit(test).alias("test_name"), *(cols or ("*",)))


def _any_row(df: DataFrame) -> Column:
    return df.select(F.lit(1)).limit(1).agg(F.when(F.count("*") > 0, "PASS").otherwise("FAIL")).scalar()


def _count(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def tables_nonempty(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    one = customers.limit(1).agg(F.when(F.count("*") > 0, "PASS").otherwise("FAIL").alias("customers_test"))
    return _named("Table Existence Check", one, "customers_test", _any_row(products).alias("products_test"),
                  _any_row(orders).alias("orders_test"))


def count_validation(customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    return _named("Data Count Validation", customers.agg(F.count("*").alias("customer_count")), "customer_count",
                  _count(products).alias("product_count"), _count(orders).alias("order_count"),
                  _count(items).alias("order_items_count"))


def null_key_check(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    nulls = lambda df, c: df.agg(count_if(F.col(c).isNull()).alias("n"))
    return _named("NULL Value Check", nulls(customers, "customer_id"), F.col("n").alias("null_customer_ids"),
                  nulls(products, "product_id").scalar().alias("null_product_ids"),
                  nulls(orders, "order_id").scalar().alias("null_order_ids"))


def email_validation(customers: DataFrame) -> DataFrame:
    ok = F.col("email").rlike(EMAIL_PATTERN)
    return _named("Email Validation", customers.agg(
        F.count("*").alias("total_customers"), count_if(ok).alias("valid_emails"),
        count_if(F.col("email").isNull() | ~ok).alias("invalid_emails")))


def price_validation(products: DataFrame) -> DataFrame:
    price, cost = F.col("price"), F.col("cost")
    return _named("Price Validation", products.agg(
        F.count("*").alias("total_products"),
        count_if((price > 0) & (cost > 0) & (price > cost)).alias("valid_pricing"),
        count_if((price <= 0) | (cost <= 0) | (price <= cost)).alias("invalid_pricing")))


def amount_validation(orders: DataFrame) -> DataFrame:
    x = F.col("total_amount")
    return _named("Order Amount Validation", orders.agg(
        F.count("*").alias("total_orders"), count_if(x > 0).alias("positive_amounts"),
        count_if(x <= 0).alias("non_positive_amounts"), dbl(F.min(x)).alias("min_amount"),
        dbl(F.max(x)).alias("max_amount"), mean(x).alias("avg_amount")))


def _known(parent: DataFrame, key: str, flag: str) -> DataFrame:
    """Distinct parent keys; a repeated parent must not repeat its children."""
    return parent.select(key).distinct().withColumn(flag, F.lit(True))


def orphan_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    per_key = orders.groupBy("customer_id").agg(F.count("*").alias("n"))
    found = per_key.join(_known(customers, "customer_id", "hit"), "customer_id", "left")
    return _named("Orphaned Orders Check", found.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("orders_with_valid_customers"),
        F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("n"))), F.lit(0)).alias("orphaned_orders")))


def orphan_order_items(items: DataFrame, orders: DataFrame, products: DataFrame, variant: str = "v1") -> DataFrame:
    """Items without order and, in v1, without product; each side is counted per key."""
    def side(key: str, parent: DataFrame) -> DataFrame:
        per_key = items.groupBy(key).agg(F.count("*").alias("n"))
        found = per_key.join(_known(parent, key, "hit"), key, "left")
        return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                         F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("ok"))

    by_order = side("order_id", orders)
    n, ok = F.col("n"), F.col("ok")
    base = [n.alias("total_order_items"), ok.alias("items_with_valid_orders")]
    if variant == "v2":
        return _named("Orphaned Order Items Check", by_order, *base, (n - ok).alias("orphaned_items"))
    out = by_order.withColumn("ok_products", side("product_id", products).select("ok").scalar())
    return _named("Orphaned Order Items Check", out, *base, F.col("ok_products").alias("items_with_valid_products"),
                  (n - ok).alias("items_missing_orders"), (n - F.col("ok_products")).alias("items_missing_products"))


def order_total_verification(orders: DataFrame, items: DataFrame) -> DataFrame:
    lines = items.groupBy("order_id").agg(F.sum("line_total").alias("lines"))
    gap = F.abs(F.col("total_amount") - F.coalesce("lines", F.lit(0)))
    diff = orders.select("order_id", "total_amount").join(lines, "order_id", "left").withColumn("gap", gap)
    return _named("Order Total Verification", diff.agg(
        F.count("*").alias("total_orders"), count_if(F.col("gap") < F.expr("0.01BD")).alias("matching_totals"),
        count_if(F.col("gap") >= F.expr("0.01BD")).alias("mismatched_totals"), dbl(F.max("gap")).alias("max_difference")))


def date_range_validation(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Two independent aggregates; all NULL when either table is empty."""
    reg = customers.agg(F.count("*").alias("n"), F.to_date(F.min("registration_date")).alias("lo"),
                        F.to_date(F.max("registration_date")).alias("hi"))
    placed = orders.agg(F.count("*").alias("n"), F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    both = reg.select(F.struct("*").alias("r"), placed.select(F.struct("*")).scalar().alias("o"))
    filled = (F.col("r.n") > 0) & (F.col("o.n") > 0)
    text = lambda c: F.when(filled, F.to_date(c).cast("string"))
    logic = F.when(filled & (F.to_date("o.lo") >= F.col("r.lo")), "PASS").otherwise("FAIL")
    return _named("Date Range Validation", both, text("r.lo").alias("earliest_registration"),
                  text("r.hi").alias("latest_registration"), text("o.lo").alias("earliest_order"),
                  text("o.hi").alias("latest_order"), logic.alias("date_logic_check"))


def partition_prune_count(orders: DataFrame, ds: str) -> DataFrame:
    return _named("Partition Pruning Test", orders.filter(F.col("ds") == ds).agg(
        F.count("*").alias("records_in_partition")), "records_in_partition", F.lit(NOTE_PRUNING).alias("note"))


def in_list_distinct(orders: DataFrame, customer_ids: list) -> DataFrame:
    return _named("Customer Lookup Test", orders.filter(F.col("customer_id").isin(customer_ids)).agg(
        F.countDistinct("customer_id").alias("unique_customers")), "unique_customers", F.lit(NOTE_LOOKUP).alias("note"))


def aggregation_consistency(orders: DataFrame, items: DataFrame) -> DataFrame:
    heads = orders.agg(F.countDistinct("customer_id").alias("c"), F.countDistinct("order_id").alias("o"),
                       F.sum("total_amount").alias("s"))
    per_order = items.groupBy("order_id").agg(F.sum("line_total").alias("lines"))
    joined = per_order.join(orders.select("order_id", "customer_id"), "order_id")
    detail = joined.agg(F.countDistinct("customer_id").alias("c"), F.countDistinct("order_id").alias("o"),
                        F.sum("lines").alias("s"))
    both = heads.select(F.struct("*").alias("h"), detail.select(F.struct("*")).scalar().alias("d"))
    check = F.when(F.abs(F.col("h.s") - F.col("d.s")) < 1, "PASS").otherwise("FAIL")
    money = lambda c: dbl(F.round(c, 2))
    return _named("Aggregation Consistency", both, F.col("h.c").alias("unique_customers"),
                  F.col("d.c").alias("unique_customers_detailed"), F.col("h.o").alias("unique_orders"),
                  F.col("d.o").alias("unique_orders_detailed"), money("h.s").alias("order_total_revenue"),
                  money("d.s").alias("item_total_revenue"), check.alias("revenue_consistency_check"))


def distribution_pct(customers: DataFrame) -> DataFrame:
    """Share of each country; the total is a scalar, not a whole-table window."""
    counts = customers.groupBy("country").agg(F.count("*").alias("count"))
    whole = customers.agg(F.count("*")).scalar()
    return _named("Data Distribution Check", counts, F.lit("Customers by Country").alias("metric"), "country", "count",
                  F.round(dbl("count") * 100.0 / whole, 2).alias("percentage")).orderBy(F.desc("count"), "country")


def category_price_stats(products: DataFrame) -> DataFrame:
    p = F.col("price")
    stats = products.groupBy("category").agg(
        F.count("*").alias("product_count"), F.round(mean(p), 2).alias("avg_price"),
        dbl(F.round(F.min(p), 2)).alias("min_price"), dbl(F.round(F.max(p), 2)).alias("max_price"))
    return _named("Product Category Distribution", stats).orderBy(F.desc("product_count"), "category")


def health_summary(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    def health(df: DataFrame, table: str, key: str, good: Column) -> DataFrame:
        return df.agg(F.lit(table).alias("table_name"), F.count("*").alias("total_records"),
                      F.count(key).alias("records_with_key"), count_if(good).alias("quality_records"))

    parts = health(customers, "customers", "customer_id", F.col("email").rlike(EMAIL_PATTERN)).unionByName(
        health(products, "products", "product_id", (F.col("price") > 0) & (F.col("cost") > 0))
    ).unionByName(health(orders, "orders", "order_id", F.col("total_amount") > 0))
    n, k, q = F.col("total_records"), F.col("records_with_key"), F.col("quality_records")
    # whole-number comparisons, so a share of exactly 95 % counts as reached
    at_least = lambda keys, good: (n > 0) & (k * 100 >= n * keys) & (q * 100 >= n * good)
    grade = F.when(at_least(95, 90), "EXCELLENT").when(at_least(90, 80), "GOOD").when(at_least(80, 70), "FAIR")
    share = lambda x: F.round(F.try_divide(dbl(x) * 100.0, dbl(n)), 2)
    return parts.select("*", share(k).alias("key_completeness_pct"), share(q).alias("data_quality_pct"),
                        grade.otherwise("NEEDS_IMPROVEMENT").alias("overall_health")).orderBy("table_name")
