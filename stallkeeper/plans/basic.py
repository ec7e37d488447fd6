"""Single-table lookups, filters and small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import dbl, label


def customers_in_country(customers: DataFrame, country: str) -> DataFrame:
    return (
        customers.filter(F.col("country") == country)
        .select("customer_id", "first_name", "last_name", "city").orderBy("city", "customer_id")
    )


def customers_per_country(customers: DataFrame) -> DataFrame:
    counts = customers.groupBy("country").agg(F.count("*").alias("customer_count"))
    return counts.orderBy(F.desc("customer_count"), "country")


def days_since_launch(products: DataFrame, as_of: str) -> DataFrame:
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("launch_date"))
    return (
        products.filter(F.col("launch_date").isNotNull())
        .select("product_id", "product_name", F.col("launch_date").cast("string").alias("launch_date"),
                age.alias("days_since_launch"))
        .orderBy("days_since_launch", "product_id")
    )


def orders_in_partition(orders: DataFrame, ds: str) -> DataFrame:
    return (
        orders.filter(F.col("ds") == ds)
        .select("order_id", "customer_id", dbl("total_amount").alias("total_amount"), "order_status")
        .orderBy(F.desc("total_amount"), "order_id")
    )


def orders_on_run_dates(orders: DataFrame, run_dates: DataFrame) -> DataFrame:
    """Orders and revenue of the chosen run dates.

    ``orders`` lies in ``ds`` folders: the dates found in the small, filtered table prune them while the query runs, so
    only the folders of those dates are listed and read.
    """
    return orders.join(run_dates.select("ds"), "ds").groupBy("ds").agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("customer_id").alias("customers"), F.round(F.sum(F.col("total_amount").cast("decimal(20,6)")), 2).cast("double").alias("revenue"))


def brands_like(products: DataFrame, text: str) -> DataFrame:
    return products.filter(F.lower("brand").contains(text.lower())).select(
        "product_id", "product_name", "brand", F.upper("brand").alias("brand_upper")
    )


def order_date_parts(orders: DataFrame, from_ds: str, rows: int = 10) -> DataFrame:
    """First ``rows`` orders; day of week counts from Sunday = 1."""
    d = F.col("order_date")
    return (
        orders.filter(F.col("ds") >= from_ds).orderBy("order_id").limit(rows)
        .select("order_id", "order_date", F.year(d).alias("order_year"), F.month(d).alias("order_month"),
                F.dayofweek(d).alias("day_of_week"), F.date_format(d, "yyyy-MM-dd").alias("order_date_formatted"))
    )


def profit_margins(products: DataFrame) -> DataFrame:
    gain = F.col("price") - F.col("cost")
    margin = dbl(gain) / dbl("price") * 100
    return (
        products.filter((F.col("price") > 0) & (F.col("cost") > 0))
        .select("product_id", "product_name", dbl("price").alias("price"), dbl("cost").alias("cost"),
                dbl(F.round(gain, 2)).alias("profit"), F.round(margin, 2).alias("profit_margin_pct"),
                # gain * 100 > price * k keeps the band test exact
                label([(gain * 100 > F.col("price") * 50, "High Margin"),
                       (gain * 100 > F.col("price") * 25, "Medium Margin")], "Low Margin").alias("margin_category"))
        .orderBy(F.desc("profit_margin_pct"), "product_id")
    )


def customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    # distinct first: a customer with very many orders stays one row
    buyers = orders.select("customer_id").distinct()
    return customers.join(buyers, "customer_id", "left_semi").select(
        "customer_id", "first_name", "last_name", "country"
    )


def product_page(products: DataFrame, page: int, page_size: int = 5) -> DataFrame:
    return (
        products.select("product_id", "product_name", "category", dbl("price").alias("price"))
        .orderBy("product_id").offset((page - 1) * page_size).limit(page_size)
    )


def fill_missing(customers: DataFrame) -> DataFrame:
    email = F.when(F.col("email").isNull(), "No Email").when(F.col("email") == "", "Empty Email").otherwise(F.col("email"))
    return customers.select(
        "customer_id",
        F.coalesce("first_name", F.lit("Unknown")).alias("first_name"),
        F.coalesce("last_name", F.lit("Unknown")).alias("last_name"),
        F.coalesce("phone", F.lit("No Phone")).alias("phone"),
        email.alias("email_clean"),
    )
