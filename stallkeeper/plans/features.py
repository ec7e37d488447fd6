"""Customer and product features, incremental loads and change application."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import count_if, dbl, label, mean, pct, ratio
from ..session import TASK_ROWS, parts_for, stage
from .analytics import product_order_facts, profit, spend_by_customer


def top_customers(customers: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    """Spend is ranked first; only ``k`` rows meet the customer table."""
    best = spend_by_customer(orders).orderBy(F.desc_nulls_last("spent"), "customer_id").limit(k)
    return customers.select("customer_id", "first_name", "last_name", "country").join(best, "customer_id").select(
        "customer_id", "first_name", "last_name", "country", dbl("spent").alias("total_spent"), "total_orders")


def aov_by_country(customers: DataFrame, orders: DataFrame) -> DataFrame:
    per_customer = spend_by_customer(orders).join(customers.select("customer_id", "country"), "customer_id")
    return per_customer.groupBy("country").agg(
        F.sum("total_orders").alias("total_orders"),
        ratio(F.sum("spent"), F.sum("priced_orders")).alias("avg_order_value"))


def inactive_customers(customers: DataFrame, orders: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    recent = orders.filter(F.to_date("order_date") >= since).select("customer_id").distinct()
    return customers.select("customer_id", "first_name", "last_name", "country").join(recent, "customer_id", "left_anti")


def top_products_per_category(products: DataFrame, items: DataFrame, k: int = 3) -> DataFrame:
    """Best ``k`` products per category.

    Spark trims each map task to ``k`` rows per category before the shuffle,
    so a category with most of the products stays small.
    """
    revenue = items.groupBy("product_id").agg(F.sum("line_total").alias("revenue"))
    w = Window.partitionBy("category").orderBy(F.desc("revenue"), "product_id")
    return (
        products.select("product_id", "product_name", "category").join(revenue, "product_id")
        .withColumn("category_rank", F.row_number().over(w).cast("bigint")).filter(F.col("category_rank") <= k)
        .select("category", "category_rank", "product_id", "product_name", dbl("revenue").alias("total_revenue"))
    )


def underperforming_products(products: DataFrame, items: DataFrame, orders: DataFrame, min_margin: float = 45.0,
                             min_revenue: float = 50.0) -> DataFrame:
    """Margin per product; flagged when unsold, thin or slow."""
    m = products.select("product_id", "product_name", "category", "cost").join(
        product_order_facts(items, orders), "product_id", "left")
    margin = F.try_divide(dbl(profit()) * 100.0, dbl("revenue"))
    flag = label([(F.col("revenue").isNull(), "NO_SALES"), (margin < min_margin, "LOW_MARGIN"),
                  (dbl("revenue") < min_revenue, "LOW_REVENUE")], "OK")
    return m.select("product_id", "product_name", "category", F.coalesce(dbl("revenue"), F.lit(0.0)).alias("total_revenue"),
                    F.round(margin, 4).alias("profit_margin_pct"), flag.alias("flag"))


def newer_than_target(source: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Source rows past the target's high-water mark (all when it is empty)."""
    mark = target.agg(F.max(ts)).scalar()
    return source.filter(mark.isNull() | (F.col(ts) > mark))


def dashboard_feed(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Event counts and purchase value per window, batch or streaming."""
    buying = F.col("event_type") == "purchase"
    counts = events.groupBy(F.window("ts", width)).agg(
        F.count("*").alias("events"), count_if(buying).alias("purchases"),
        F.coalesce(F.sum(F.when(buying, F.col("value").cast("decimal(18,4)"))), F.lit(0)).cast("double").alias("purchase_value"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         "events", "purchases", "purchase_value")


PAYLOAD = "first_name string, last_name string, email string"


def cdc_apply(base: DataFrame, changes: DataFrame, order_by: str | None = None, sequence: str | None = None) -> DataFrame:
    """Base table after the changes: the latest change of a key wins, by ``order_by`` and then ``sequence``.

    Equal times without a sequence fall to the larger payload, so a rerun gives the same table.  A payload that
    is not whole JSON with all fields stops the job.
    """
    latest = changes
    if order_by:
        last = F.struct(order_by, *([sequence] if sequence else []), "change_type", "new_data")
        latest = changes.groupBy("customer_id").agg(F.max(last).alias("c")).select("customer_id", "c.change_type", "c.new_data")
    names = F.array(*[F.lit(c.split()[0]) for c in PAYLOAD.split(", ")])
    whole = F.coalesce(F.size(F.array_except(names, F.json_object_keys("new_data"))) == 0, F.lit(False))
    parsed = F.when((F.col("change_type") != "DELETE") & ~whole, F.raise_error(F.concat(
        F.lit("change without a whole payload: "), F.col("customer_id").cast("string"))).cast(
        "struct<first_name:string,last_name:string,email:string>")).otherwise(F.from_json("new_data", PAYLOAD))
    new = latest.select("customer_id", "change_type", parsed.alias("n"))
    old = base.select("customer_id", F.struct("first_name", "last_name", "email").alias("o"))
    merged = old.join(new, "customer_id", "full_outer").filter(F.coalesce(F.col("change_type"), F.lit("")) != "DELETE")
    return merged.select("customer_id", F.when(F.col("change_type").isNotNull(), F.col("n")).otherwise(F.col("o")).alias("r")).select(
        "customer_id", "r.*")


def customer_features(customers: DataFrame, orders: DataFrame, items: DataFrame, as_of: str) -> DataFrame:
    """Behaviour of each customer up to ``as_of``."""
    seen = orders.filter(F.to_date("order_date") <= F.lit(as_of).cast("date"))
    size = items.groupBy("order_id").agg(F.sum("quantity").alias("units"), F.sum("discount_amount").alias("discount"),
                                         F.sum("line_total").alias("lines"))
    x = F.col("total_amount")
    per_customer = seen.join(size, "order_id", "left").groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.sum(x).alias("spent"), F.count(x).alias("priced"), F.max(x).alias("largest"),
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"), F.sum("discount").alias("discount"), F.sum("lines").alias("lines"),
        count_if(F.col("order_status") == "completed").alias("done"),
        count_if(F.dayofweek("order_date").isin(1, 7)).alias("weekend"))
    day = F.lit(as_of).cast("date")
    return customers.select("customer_id", "registration_date").join(per_customer, "customer_id", "left").select(
        "customer_id", F.datediff(day, F.to_date("registration_date")).alias("tenure_days"),
        F.coalesce("orders", F.lit(0)).alias("order_count"), F.coalesce(dbl("spent"), F.lit(0.0)).alias("total_spent"),
        ratio(F.col("spent"), F.col("priced")).alias("avg_order_value"), dbl("largest").alias("max_order_value"),
        F.datediff(day, F.to_date("last_order")).alias("recency_days"),
        ratio(F.datediff(F.to_date("last_order"), F.to_date("first_order")), F.nullif(F.col("orders") - 1, F.lit(0))).alias("avg_gap_days"),
        F.coalesce("units", F.lit(0)).alias("units_bought"),
        pct(F.col("done"), F.col("orders")).alias("completed_pct"), pct(F.col("weekend"), F.col("orders")).alias("weekend_pct"),
        ratio(F.col("discount"), F.col("discount") + F.col("lines")).alias("discount_share"))


def copurchase_features(items: DataFrame, anchors: DataFrame) -> DataFrame:
    """Products bought together with each anchor product: support and lift.

    ``anchors`` (column ``product_id``) is a short list such as the
    best-sellers.  Work is one row per line of a basket holding an anchor and
    anchor in it; pairs of two arbitrary products are never formed.
    """
    lines = items.select("order_id", "product_id").distinct()
    chosen = anchors.select(F.col("product_id").alias("anchor_id")).distinct()
    with_anchor = lines.join(chosen, lines["product_id"] == chosen["anchor_id"]).select("order_id", "anchor_id")
    baskets = lines.agg(F.countDistinct("order_id")).scalar()
    sold = lines.groupBy("product_id").agg(F.count("*").alias("n"))
    together = lines.join(with_anchor, "order_id").filter(F.col("product_id") != F.col("anchor_id")).groupBy(
        "anchor_id", "product_id").agg(F.count("*").alias("together"))
    return (
        together.join(sold.select("product_id", F.col("n").alias("n_product")), "product_id")
        .join(sold.select(F.col("product_id").alias("anchor_id"), F.col("n").alias("n_anchor")), "anchor_id")
        .withColumn("baskets", baskets)
        .select("anchor_id", F.col("product_id").alias("partner_id"), "together",
                ratio(F.col("together"), F.col("baskets")).alias("support"),
                ratio(F.col("together"), F.col("n_anchor")).alias("confidence"),
                ratio(F.col("together") * F.col("baskets"), F.col("n_anchor") * F.col("n_product")).alias("lift"))
    )


BASKET_BLOCK = 256  # lines of a basket that meet as one block


def basket_blocks(lines: DataFrame, block: int = BASKET_BLOCK) -> DataFrame:
    """(order_id, product_id, blocks, at): a basket of more than ``block`` lines is cut into blocks by a hash of the product."""
    large = lines.groupBy("order_id").agg(F.count("*").alias("n")).filter(F.col("n") > block).select(
        "order_id", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    return lines.join(large, "order_id", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "at", F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int"))


def block_pairs(blocked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of a basket join: each line once for every pair of blocks that it takes part in, so a basket of any size is dealt to many tasks."""
    left = blocked.select("order_id", F.col("product_id").alias("a"), F.col("at").alias("i"), F.explode(F.sequence("at", F.col("blocks") - 1)).alias("j"))
    right = blocked.select("order_id", F.col("product_id").alias("b"), F.col("at").alias("j"), F.explode(F.sequence(F.lit(0), "at")).alias("i"))
    return left, right


def copurchase_pairs(items: DataFrame, min_together: int = 2, block: int = BASKET_BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """All pairs of products bought together at least ``min_together`` times: support, confidence and lift.

    Products sold in fewer baskets cannot reach that and leave before the join.  Each unordered pair of a basket is
    formed once, by the pair of blocks its products lie in; the result has both directions.  Lines and pairs are dealt to
    as many tasks as their numbers ask for, so that what a task holds does not grow with the table.
    """
    width = parts_for(items.sparkSession, items.count(), task_rows)
    by_order = lambda df: df.repartition(width, "order_id")  # noqa: E731  baskets are as many as orders: never grouped by a whole file
    lines = stage(by_order(items.select("order_id", "product_id")).distinct(), "lines")
    baskets = by_order(lines.select("order_id")).distinct().agg(F.count("order_id")).scalar()
    sold = lines.groupBy("product_id").agg(F.count("*").alias("n")).filter(F.col("n") >= min_together)
    blocked = stage(basket_blocks(by_order(lines.join(sold.select("product_id"), "product_id", "left_semi")), block), "blocks")
    a, b = block_pairs(blocked)
    # an upper bound of the pairs: every two lines of a basket
    size = by_order(blocked.select("order_id")).groupBy("order_id").agg(F.count("*").alias("n"))
    rows, pairs = size.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0))).first()
    parts = parts_for(items.sparkSession, max(rows, pairs), task_rows)
    cell = ["order_id", "i", "j"]
    met = a.repartition(parts, *cell).join(b.repartition(parts, *cell), cell).filter("i < j or a < b")
    together = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).repartition(parts, "a", "b").groupBy("a", "b").agg(F.count("*").alias("together")).filter(F.col("together") >= min_together)
    both = together.select("together", F.explode(F.array(F.struct(F.col("a").alias("anchor_id"), F.col("b").alias("partner_id")),
                                                         F.struct(F.col("b").alias("anchor_id"), F.col("a").alias("partner_id")))).alias("p"))
    return (
        both.select("p.*", "together")
        .join(sold.select(F.col("product_id").alias("partner_id"), F.col("n").alias("n_product")), "partner_id")
        .join(sold.select(F.col("product_id").alias("anchor_id"), F.col("n").alias("n_anchor")), "anchor_id")
        .withColumn("baskets", baskets)
        .select("anchor_id", "partner_id", "together", ratio(F.col("together"), F.col("baskets")).alias("support"),
                ratio(F.col("together"), F.col("n_anchor")).alias("confidence"),
                ratio(F.col("together") * F.col("baskets"), F.col("n_anchor") * F.col("n_product")).alias("lift"))
    )


def best_sellers(items: DataFrame, k: int = 10) -> DataFrame:
    return items.groupBy("product_id").agg(F.sum("quantity").alias("q")).orderBy(F.desc("q"), "product_id").limit(k)


def churn_dataset(customers: DataFrame, orders: DataFrame, cutoff: str, horizon: int = 90) -> DataFrame:
    """Features up to ``cutoff``; churned without an order in the next days.

    Only customers seen before the cutoff are labelled.
    """
    day, t = F.to_date("order_date"), F.lit(cutoff).cast("date")
    x = F.col("total_amount")
    before = orders.filter(day <= t).groupBy("customer_id").agg(
        F.count("*").alias("order_count"), F.sum(x).alias("spent"), F.count(x).alias("priced"),
        F.max(day).alias("last_day"), count_if(day > F.date_sub(t, 180)).alias("orders_180d"))
    after = orders.filter((day > t) & (day <= F.date_add(t, horizon))).groupBy("customer_id").agg(F.count("*").alias("next_orders"))
    return before.join(after, "customer_id", "left").join(customers.select("customer_id", "country"), "customer_id").select(
        "customer_id", "country", "order_count", dbl("spent").alias("total_spent"),
        ratio(F.col("spent"), F.col("priced")).alias("avg_order_value"), F.datediff(t, "last_day").alias("recency_days"),
        "orders_180d", F.when(F.col("next_orders").isNull(), 1).otherwise(0).alias("churned"))
