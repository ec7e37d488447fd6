"""Layered ETL jobs: detail summaries and application tables for one run date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import count_if, dbl, label, mean, pct, ratio, total
from ..operators.ordered import number_rows
from ..session import stage
from .analytics import customer_spend, product_order_facts, profit


# ---- sales ---------------------------------------------------------------

def top_category(items: DataFrame, products: DataFrame, orders: DataFrame, ds: str) -> DataFrame:
    """Category with the highest line revenue of one load partition."""
    return _best_category(_product_revenue(items, _orders_of(orders, ds)), products)


def top_product(items: DataFrame, orders: DataFrame, ds: str) -> DataFrame:
    return _best_product(_product_revenue(items, _orders_of(orders, ds)))


def _orders_of(orders: DataFrame, ds: str) -> DataFrame:
    return orders.filter(F.col("ds") == ds).select("order_id")


def _product_revenue(items: DataFrame, in_ds: DataFrame) -> DataFrame:
    return (
        items.select("order_id", "product_id", "line_total").join(in_ds, "order_id")
        .groupBy("product_id").agg(F.sum("line_total").alias("revenue"))
    )


def _best_category(per_product: DataFrame, products: DataFrame) -> DataFrame:
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category").agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "category").limit(1)
        .select(F.col("category").alias("top_category"), dbl("revenue").alias("category_revenue"))
    )


def _best_product(per_product: DataFrame) -> DataFrame:
    return (
        per_product.orderBy(F.desc("revenue"), "product_id").limit(1)
        .select(F.col("product_id").alias("top_product_id"), dbl("revenue").alias("product_revenue"))
    )


def daily_sales_summary(orders: DataFrame, items: DataFrame, products: DataFrame, ds: str,
                        status: str = "completed") -> DataFrame:
    """One row for each day of the load partition, with its best category and product.

    The partition's order ids are staged, so that their size is known before the lines are moved to them; the revenue per product is
    staged for both of its readers.
    """
    per_product = stage(_product_revenue(items, stage(_orders_of(orders, ds), "month")), "revenue")
    done = orders.filter((F.col("ds") == ds) & (F.col("order_status") == status))
    daily = done.groupBy(F.date_format("order_date", "yyyy-MM-dd").alias("sales_date")).agg(
        F.countDistinct("order_id").alias("total_orders"), total("total_amount").alias("total_revenue"),
        F.countDistinct("customer_id").alias("total_customers"), mean("total_amount").alias("avg_order_value"),
    )
    return daily.select(
        "*",
        _best_category(per_product, products).select("top_category").scalar().alias("top_category"),
        _best_product(per_product).select("top_product_id").scalar().alias("top_product_id"),
    )


# ---- customers -----------------------------------------------------------

def _scale(value: Column, steps: list, at_most: bool) -> Column:
    """Score 5..1 along four limits."""
    cases = [(value <= s if at_most else value >= s, 5 - i) for i, s in enumerate(steps)]
    chain = F.when(*cases[0])
    for c in cases[1:]:
        chain = chain.when(*c)
    return chain.otherwise(1)


def rfm_scores(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    base = customers.select("customer_id", "registration_date")
    m = customer_spend(base, orders).select(
        "customer_id", "total_orders", F.coalesce("spent", F.lit(0)).alias("spent"),
        F.coalesce(ratio(F.col("spent"), F.col("priced_orders")), F.lit(0.0)).alias("avg_order_value"),
        F.datediff(F.lit(as_of).cast("date"), F.coalesce(F.to_date("last_order"), F.to_date("registration_date")))
        .alias("days_since_last_order"),
    )
    return m.select(
        "customer_id", "total_orders", dbl("spent").alias("total_spent"), "avg_order_value", "days_since_last_order",
        _scale(F.col("days_since_last_order"), [30, 60, 90, 180], at_most=True).alias("recency_score"),
        _scale(F.col("total_orders"), [10, 5, 3, 2], at_most=False).alias("frequency_score"),
        _scale(F.col("spent"), [1000, 500, 200, 100], at_most=False).alias("monetary_score"),
    )


def rfm_segments(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    points = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    names = label([(points >= 12, "Champions"), (points >= 10, "Loyal Customers"), (points >= 8, "Potential Loyalists"),
                   (points >= 6, "At Risk"), (points >= 4, "Cannot Lose")], "Lost Customers")
    return rfm_scores(customers, orders, as_of).select(
        "customer_id", F.lit("RFM").alias("segment_type"), names.alias("segment_value"), "total_orders", "total_spent",
        "avg_order_value", "days_since_last_order", (dbl(points) / 3.0).alias("segment_score"),
    )


def value_segments(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Spend bands; orders are counted once each, recency is NULL without orders."""
    per_order = orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("n"), F.sum("total_amount").alias("spent"),
        F.count("total_amount").alias("priced"), F.max("order_date").alias("last_order"),
    )
    spent = F.col("spent")
    return customers.select("customer_id").join(per_order, "customer_id", "left").select(
        "customer_id", F.lit("value_segment").alias("segment_type"),
        label([(spent >= 1000, "High Value"), (spent >= 500, "Mid Value")], "Low Value").alias("segment_value"),
        F.coalesce("n", F.lit(0)).alias("total_orders"), F.coalesce(dbl(spent), F.lit(0.0)).alias("total_spent"),
        F.coalesce(ratio(spent, F.col("priced")), F.lit(0.0)).alias("avg_order_value"),
        F.datediff(F.lit(as_of).cast("date"), F.to_date("last_order")).alias("days_since_last_order"),
        (F.coalesce(dbl(spent), F.lit(0.0)) / 100.0).alias("segment_score"),
    )


def customer_segments(customers: DataFrame, orders: DataFrame, as_of: str, variant: str = "v1") -> DataFrame:
    return (rfm_segments if variant == "v1" else value_segments)(customers, orders, as_of)


# ---- products ------------------------------------------------------------

def product_performance(products: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    zero = F.lit(0)
    m = products.select("product_id", "product_name", "category", "cost").join(
        product_order_facts(items, orders), "product_id", "left"
    ).select(
        "product_id", "product_name", "category", F.coalesce("quantity", zero).alias("total_quantity_sold"),
        F.coalesce("revenue", zero).alias("revenue"),
        F.coalesce(profit(), zero).alias("profit"),
        F.coalesce("orders_count", zero).alias("orders_count"),
        F.coalesce("unique_customers", zero).alias("unique_customers"),
        F.coalesce("avg_price", F.lit(0.0)).alias("avg_selling_price"),
    )
    # staged, as a sort by ranges reads its rows twice
    ranked = number_rows(stage(m, "facts"), [F.desc("revenue"), F.asc("product_id")]).rows
    rank, revenue = F.col("rn"), F.col("revenue")
    tier = label([(rank <= 5, "Top Performer"), (rank <= 20, "Good Performer"), (rank <= 50, "Average Performer"),
                  (revenue > 0, "Under Performer")], "No Sales")
    return ranked.select(
        "product_id", "product_name", "category", "total_quantity_sold", dbl(revenue).alias("total_revenue"),
        dbl("profit").alias("total_profit"),
        F.when(revenue > 0, dbl("profit") / dbl(revenue) * 100.0).otherwise(0.0).alias("profit_margin_pct"),
        "orders_count", "unique_customers", "avg_selling_price", rank.alias("performance_rank"),
        tier.alias("performance_tier"),
    )


# ---- web -----------------------------------------------------------------

def top_traffic_source(sessions: DataFrame, ds: str) -> DataFrame:
    return (
        sessions.filter(F.col("ds") == ds).groupBy("traffic_source").agg(F.count("*").alias("source_count"))
        .orderBy(F.desc("source_count"), "traffic_source").limit(1)
    )


def page_rank_by_views(page_views: DataFrame, ds: str) -> DataFrame:
    pages = page_views.filter(F.col("ds") == ds).groupBy("page_url").agg(
        F.countDistinct("session_id").alias("sessions_with_views"), F.count("*").alias("total_views")
    )
    rows = number_rows(pages, [F.desc("total_views"), F.asc("page_url")]).rows
    return rows.withColumnRenamed("rn", "page_rank")


def top_page(page_views: DataFrame, ds: str) -> DataFrame:
    views = page_views.filter(F.col("ds") == ds).groupBy("page_url").agg(F.count("*").alias("total_views"))
    return views.orderBy(F.desc("total_views"), "page_url").limit(1).select("page_url")


def mark_converted(sessions: DataFrame, orders: DataFrame, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """Flag sessions that share the key with any order.

    ``date`` is the calendar day of session start and order.  Orders shrink to
    their distinct keys first, so sessions never multiply.
    """
    on = [("_day" if k == "date" else k) for k in keys]
    days = orders.withColumn("_day", F.to_date("order_date")).select(*on).distinct().withColumn("converted", F.lit(True))
    if keys == ("date",):
        # one row per calendar day at most, while all sessions of a day share one key
        days = F.broadcast(days)
    dated = sessions.withColumn("_day", F.to_date("session_start"))
    return dated.join(days, on, "left").withColumn("converted", F.coalesce("converted", F.lit(False))).drop("_day")


def session_conversion(sessions: DataFrame, orders: DataFrame, ds: str, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    marked = mark_converted(sessions.filter(F.col("ds") == ds), orders, keys)
    return marked.agg(
        F.countDistinct("session_id").alias("total_sessions_count"),
        F.countDistinct(F.when(F.col("converted"), F.col("session_id"))).alias("converted_sessions"),
    )


def web_analytics_summary(sessions: DataFrame, page_views: DataFrame, orders: DataFrame, ds: str,
                          keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """One row for ``ds``; no row when the day has no sessions."""
    today = mark_converted(sessions.filter(F.col("ds") == ds), orders, keys)
    n = F.count("*")
    day = today.agg(
        F.countDistinct("session_id").alias("total_sessions"), F.countDistinct("user_id").alias("unique_users"),
        F.sum("page_views").alias("total_page_views"), mean("session_duration_seconds").alias("avg_session_duration"),
        pct(count_if(F.col("page_views") == 1), n).alias("bounce_rate"),
        F.countDistinct(F.when(F.col("converted"), F.col("session_id"))).alias("_converted"),
        pct(count_if(F.col("device_type") == "mobile"), n).alias("mobile_percentage"),
    ).filter(F.col("total_sessions") > 0)
    return day.select(
        F.lit(ds).alias("analysis_date"), "total_sessions", "unique_users", "total_page_views", "avg_session_duration",
        "bounce_rate", pct(F.col("_converted"), F.col("total_sessions")).alias("conversion_rate"),
        top_traffic_source(sessions, ds).select("traffic_source").scalar().alias("top_traffic_source"),
        top_page(page_views, ds).scalar().alias("top_page"), "mobile_percentage",
    )


# ---- change detection ----------------------------------------------------

def _payload(side: str, variant: str) -> Column:
    if variant == "rows":
        whole = F.to_json(F.struct(*[F.col(f"{side}.{f}").alias(f) for f in ("first_name", "last_name", "email")]), {"ignoreNullFields": "false"})
        return F.when(F.col(f"{side}.customer_id").isNotNull(), whole)
    fields = ["first_name", "last_name", "email"] if variant == "v1" else ["first_name", "email"]
    parts: list[Column] = []
    for i, f in enumerate(fields):
        value = F.col(f"{side}.{f}")
        parts += [F.lit(("{" if i == 0 else ",") + f'"{f}":"'), value if variant == "v1" else F.coalesce(value, F.lit("")), F.lit('"')]
    return F.when(F.col(f"{side}.customer_id").isNotNull(), F.concat(*parts, F.lit("}")))


def snapshot_change_detect(current: DataFrame, previous: DataFrame, variant: str = "v1",
                           null_safe: bool = False) -> DataFrame:
    """Rows added, removed or changed between two snapshots.

    Without ``null_safe`` a change from or to NULL goes unnoticed, as with a
    plain ``<>``.  A NULL field makes the whole v1 payload NULL, v2 leaves out the last name; ``variant="rows"`` is
    a lossless payload, the one that ``cdc_apply`` takes.
    """
    cols = ["customer_id", "first_name", "last_name", "email"]
    cur, old = current.select(*cols).alias("cur"), previous.select(*cols).alias("old")

    def differs(f: str) -> Column:
        a, b = F.col(f"cur.{f}"), F.col(f"old.{f}")
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    added, gone = F.col("old.customer_id").isNull(), F.col("cur.customer_id").isNull()
    changed = differs("first_name") | differs("last_name") | differs("email")
    return (
        cur.join(old, F.col("cur.customer_id") == F.col("old.customer_id"), "full_outer")
        .filter(added | gone | changed)
        .select(F.coalesce("cur.customer_id", "old.customer_id").alias("customer_id"),
                label([(added, "INSERT"), (gone, "DELETE")], "UPDATE").alias("change_type"),
                _payload("old", variant).alias("old_data"), _payload("cur", variant).alias("new_data"),
                F.lit(False).alias("processed"))
    )


# ---- quality metrics -----------------------------------------------------

def _metric(df: DataFrame, table: str, name: str, bad: Column, limit: float, otherwise: str) -> DataFrame:
    value = pct(count_if(bad), F.count("*"))
    return df.agg(value.alias("metric_value"), count_if(bad).alias("_bad")).select(
        F.lit(table).alias("table_name"), F.lit(name).alias("metric_name"), "metric_value",
        F.lit(limit).alias("threshold_value"),
        F.when((F.col("_bad") == 0) | (F.col("metric_value") <= limit), "PASS").otherwise(otherwise).alias("status"),
    )


def dq_metrics(customers: DataFrame, orders: DataFrame, products: DataFrame, ds: str, variant: str = "v1") -> DataFrame:
    """Three monitoring rates; v2 checks all order partitions with a zero limit."""
    no_mail, bad_amount = F.col("email").isNull(), F.col("total_amount") <= 0
    bad_price = F.col("price") <= F.col("cost")
    mails = _metric(customers, "customers", "null_email_rate", no_mail, 5.0, "FAIL")
    if variant == "v1":
        amounts = _metric(orders.filter(F.col("ds") == ds), "orders", "negative_amount_rate", bad_amount, 1.0, "FAIL")
        prices = _metric(products, "products", "price_cost_consistency", bad_price, 2.0, "FAIL")
    else:
        amounts = _metric(orders, "orders", "negative_amount_rate", bad_amount, 0.0, "FAIL")
        prices = _metric(products, "products", "price_below_cost_rate", bad_price, 2.0, "WARNING")
    return mails.unionByName(amounts).unionByName(prices)
