"""Joins and window analytics over customers, orders, items and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import count_if, dbl, label, mean, ratio, total
from ..operators.ordered import (
    BLOCK_ROWS, ntile, number_rows, running_and_neighbours, with_next, with_ranks,
)
from ..session import TASK_ROWS, parts_for


def full_name(first: str | Column = "first_name", last: str | Column = "last_name") -> Column:
    return F.concat(first, F.lit(" "), last)


def spend_by_customer(orders: DataFrame) -> DataFrame:
    """One row per customer; partial sums keep a hot customer small in the shuffle."""
    amount = F.col("total_amount")
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), F.sum(amount).alias("spent"),
        F.count(amount).alias("priced_orders"), F.max("order_date").alias("last_order"),
    )


def customer_spend(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with order totals; NULL ``spent`` when there are none."""
    return customers.join(spend_by_customer(orders), "customer_id", "left").withColumn(
        "total_orders", F.coalesce("total_orders", F.lit(0))
    )


def orders_with_customer(orders: DataFrame, customers: DataFrame, from_ds: str) -> DataFrame:
    picked = orders.filter(F.col("ds") >= from_ds).select("order_id", "customer_id", "order_date", "total_amount")
    people = customers.select("customer_id", "first_name", "last_name", "country")
    return (
        picked.join(people, "customer_id")
        .select("order_id", "order_date", dbl("total_amount").alias("total_amount"), "first_name", "last_name", "country")
        .orderBy("order_date", "order_id")
    )


def customer_order_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        customer_spend(customers.select("customer_id", "first_name", "last_name"), orders)
        .select("customer_id", "first_name", "last_name", "total_orders",
                F.coalesce(dbl("spent"), F.lit(0.0)).alias("total_spent"),
                F.coalesce(ratio(F.col("spent"), F.col("priced_orders")), F.lit(0.0)).alias("avg_order_value"))
        .orderBy(F.desc("total_spent"), "customer_id")
    )


def order_line_detail(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame,
                      from_ds: str) -> DataFrame:
    heads = orders.filter(F.col("ds") >= from_ds).select("order_id", "customer_id", "order_date")
    people = customers.select("customer_id", full_name().alias("customer_name"))
    goods = products.select("product_id", "product_name", "category")
    lines = items.select("order_id", "product_id", "quantity", "unit_price", "line_total")
    return (
        lines.join(heads, "order_id").join(people, "customer_id").join(goods, "product_id")
        .select("order_id", "order_date", "customer_name", "product_name", "category", "quantity",
                dbl("unit_price").alias("unit_price"), dbl("line_total").alias("line_total"))
        .orderBy("order_date", "order_id")
    )


def customer_spend_ranks(customers: DataFrame, orders: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    spend = customer_spend(customers.select("customer_id", "first_name", "last_name"), orders).select(
        "customer_id", "first_name", "last_name", F.coalesce("spent", F.lit(0)).alias("spent")
    )
    ordered = number_rows(spend, [F.desc("spent"), F.asc("customer_id")], block_rows)
    return with_ranks(ordered, "spent").select(
        "customer_id", "first_name", "last_name", dbl("spent").alias("total_spent"),
        F.col("rn").alias("spending_rank"), F.col("rank").alias("spending_rank_with_ties"),
        F.col("dense_rank").alias("dense_spending_rank"), ntile(ordered.n, 4, F.col("rn")).alias("spending_quartile"),
    )


def running_and_moving(orders: DataFrame, from_ds: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    picked = orders.filter(F.col("ds") >= from_ds).select("order_id", "order_date", "total_amount")
    ordered = number_rows(picked, [F.asc("order_date"), F.asc("order_id")], block_rows)
    out = running_and_neighbours(ordered, "total_amount", "running_total", "moving_avg_3_orders", 3,
                                 "prev_order_amount", "next_order_amount")
    return out.select(
        "order_id", "order_date", "moving_avg_3_orders",
        *[dbl(c).alias(c) for c in ("total_amount", "running_total", "prev_order_amount", "next_order_amount")],
    )


def product_order_facts(items: DataFrame, orders: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Sales per product.

    Sums are partially aggregated in the scan, so only one row per product
    and map task is shuffled.  Only (product, order) keys travel to the join
    with orders; a best-seller is spread over its orders there and over its
    customers behind it.  These keys are dealt to as many tasks as their
    number asks for: a few bytes each, Spark would pack millions of them into
    one task, whose sorts and hash tables then go to disk.
    """
    sums = items.groupBy("product_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("revenue"),
        ratio(F.sum("unit_price"), F.count("unit_price")).alias("avg_price"),
    )
    parts = parts_for(items.sparkSession, items.count(), task_rows)
    # one customer per order; orders missing from the table leave NULL
    buyers = orders.select("order_id", "customer_id").repartition(parts, "order_id").groupBy("order_id").agg(
        F.max("customer_id").alias("customer_id")).withColumn("known", F.lit(True))
    lines = items.select("product_id", "order_id").repartition(parts, "product_id", "order_id").distinct()
    links = lines.repartition(parts, "order_id").join(buyers, "order_id", "left").select("product_id", "customer_id", "known")
    # one row per product and customer
    met = links.repartition(parts, "product_id", "customer_id").groupBy("product_id", "customer_id").agg(count_if(F.col("known")).alias("orders"))
    reach = met.groupBy("product_id").agg(F.sum("orders").alias("orders_count"), F.count("customer_id").alias("unique_customers"))
    return sums.join(reach, "product_id")


def profit() -> Column:
    """Revenue less cost of the units sold; the cast keeps all decimals."""
    return F.col("revenue") - F.col("quantity").cast("decimal(14,0)") * F.col("cost")


def product_sales_report(products: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    facts = product_order_facts(items, orders).filter(F.col("quantity") > 0)
    return (
        products.select("product_id", "product_name", "category", "cost").join(facts, "product_id")
        .select("product_id", "product_name", "category",
                F.col("orders_count").alias("orders_containing_product"),
                F.col("quantity").alias("total_quantity_sold"), dbl("revenue").alias("total_revenue"),
                F.col("avg_price").alias("avg_selling_price"), dbl("cost").alias("cost"),
                dbl(profit()).alias("total_profit"))
        .orderBy(F.desc("total_revenue"), "product_id")
    )


def customer_segment_rules(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    m = customer_spend(customers.select("customer_id", "first_name", "last_name"), orders).withColumn(
        "days_since_last_order", F.datediff(F.lit(as_of).cast("date"), F.to_date("last_order"))
    )
    spent, n, days = F.col("spent"), F.col("total_orders"), F.col("days_since_last_order")
    segment = label([((spent > 200) & (n > 2), "VIP"), ((spent > 100) & (n > 1), "Regular"), (n == 1, "New")], "Inactive")
    activity = label([(days.isNull(), "Never Ordered"), (days <= 30, "Active"), (days <= 90, "At Risk")], "Churned")
    return m.select(
        "customer_id", "first_name", "last_name", "total_orders", dbl("spent").alias("total_spent"),
        ratio(spent, F.col("priced_orders")).alias("avg_order_value"), "days_since_last_order",
        segment.alias("customer_segment"), activity.alias("activity_status"),
    ).orderBy(F.desc_nulls_last("total_spent"), "customer_id")


def monthly_trends(orders: DataFrame, from_ds: str) -> DataFrame:
    """Orders are folded to one row per month and customer first; an order has one customer, so only its id needs a distinct count."""
    x = F.col("total_amount")
    folded = orders.filter(F.col("ds") >= from_ds).groupBy(F.date_format("order_date", "yyyy-MM").alias("order_month"), "customer_id").agg(
        F.countDistinct("order_id").alias("n"), F.sum(x).alias("spent"), F.count(x).alias("priced"))
    return (
        folded.groupBy("order_month")
        .agg(F.sum("n").alias("total_orders"), F.count("customer_id").alias("unique_customers"), total("spent").alias("total_revenue"),
             ratio(F.sum("spent"), F.sum("priced")).alias("avg_order_value"))
        .withColumn("revenue_per_customer", ratio(F.col("total_revenue"), F.col("unique_customers")))
        .orderBy("order_month")
    )


def _residents(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("city").isNotNull() & F.col("country").isNotNull()).select(
        "customer_id", full_name().alias("name"), F.struct("country", "city").alias("place")
    ).distinct()


def same_city_pairs(customers: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Customers of one city, in linear space.

    The pairs of a city of n people are the n(n-1)/2 pairs of its customers in
    id order.  Each row links a customer to the next one and tells how many
    later partners it has: following the links from a customer yields exactly
    its pairs, and ``sum(later_partners)`` is the number of pairs.  Use
    ``same_city_partners`` to list the pairs of chosen customers.
    """
    ordered = number_rows(_residents(customers), [F.asc("place"), F.asc("customer_id")], block_rows)
    linked = with_next(ordered, F.struct("place", "customer_id", "name"), "nxt")
    ends = ordered.rows.groupBy("place").agg(F.max("rn").alias("last"))
    return (
        linked.filter(F.col("nxt.place") == F.col("place")).join(ends, "place")
        .select(F.col("customer_id").alias("customer1_id"), F.col("name").alias("customer1_name"),
                F.col("nxt.customer_id").alias("customer2_id"), F.col("nxt.name").alias("customer2_name"),
                F.col("place.city").alias("city"), F.col("place.country").alias("country"),
                (F.col("last") - F.col("rn")).alias("later_partners"))
        .orderBy("country", "city", "customer1_id")
    )


def same_city_partners(customers: DataFrame, wanted: DataFrame) -> DataFrame:
    """All pairs that contain a customer of ``wanted`` (column ``customer_id``)."""
    people = _residents(customers)
    chosen = people.join(wanted.select("customer_id").distinct(), "customer_id", "left_semi").select(
        F.col("customer_id").alias("w_id"), F.col("name").alias("w_name"), "place"
    )
    pair = people.join(chosen, "place").filter(F.col("customer_id") != F.col("w_id"))
    first = F.col("w_id") < F.col("customer_id")
    return pair.select(
        F.when(first, F.col("w_id")).otherwise(F.col("customer_id")).alias("customer1_id"),
        F.when(first, F.col("w_name")).otherwise(F.col("name")).alias("customer1_name"),
        F.when(first, F.col("customer_id")).otherwise(F.col("w_id")).alias("customer2_id"),
        F.when(first, F.col("name")).otherwise(F.col("w_name")).alias("customer2_name"),
        F.col("place.city").alias("city"), F.col("place.country").alias("country"),
    ).distinct()


def price_band_crosstab(products: DataFrame) -> DataFrame:
    p = F.col("price")
    return products.groupBy("category").agg(
        count_if(p < 50).alias("under_50"), count_if((p >= 50) & (p < 100)).alias("from_50_to_100"),
        count_if((p >= 100) & (p < 200)).alias("from_100_to_200"), count_if(p >= 200).alias("over_200"),
        F.count("*").alias("total_products"),
    ).orderBy("category")
