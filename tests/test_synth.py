"""Invariants of generated data."""

from pyspark.sql import functions as F

from stallkeeper.sources import synth


def test_rules_hold(spark):
    made = synth.gen_all(synth.row_ids(spark, 300), seed=11)
    counts = {k: v.count() for k, v in made.items()}
    assert counts == {"customers": 300, "products": 300, "orders": 600, "order_items": 900, "web_sessions": 300, "page_views": 1500, "user_events": 900}
    none = lambda df, bad: df.filter(bad).count() == 0
    c = made["customers"]
    assert c.select("customer_id").distinct().count() == 300
    assert none(c, "email <> lower(concat(first_name, '.', last_name, '@email.com'))")
    assert none(c, "country = 'USA' and phone not rlike '^[+]1-[0-9]{3}-[0-9]{3}-[0-9]{4}$'")
    assert none(c, "country not in ('USA','Canada','UK','Germany','France','Australia','Japan') and city <> 'Unknown City'")
    assert none(made["products"], "cost < 10 or cost > 500 or price < cost * 1.49 or price > cost * 3.01")
    assert none(made["orders"], "total_amount < 25 or total_amount > 500 or (total_amount > 100) <> (shipping_cost = 0)")
    assert none(made["orders"].join(c, "customer_id", "left_anti"), "true")
    i = made["order_items"]
    assert none(i, "abs(line_total - (unit_price * quantity - discount_amount)) > 0.001 or discount_amount > unit_price * 0.251")
    share = i.agg(F.avg((F.col("discount_amount") > 0).cast("int"))).first()[0]
    assert 0.2 < share < 0.4
    s = made["web_sessions"]
    assert none(s, "unix_timestamp(session_end) - unix_timestamp(session_start) <> session_duration_seconds or session_duration_seconds not between 30 and 3600")
    assert s.select("user_id").distinct().count() <= 30
    assert none(made["page_views"].join(s, "session_id", "left_anti"), "true")


def test_date_range_and_seed(spark):
    ids = synth.row_ids(spark, 50)
    o = synth.gen_orders(ids, 5, seed=1, start="2023-02-01", end="2023-02-03")
    assert {str(r[0]) for r in o.select(F.to_date("order_date")).distinct().collect()} <= {"2023-02-01", "2023-02-02"}
    rows = lambda seed: sorted(map(tuple, synth.gen_orders(ids, 5, seed=seed).collect()))
    assert rows(1) == rows(1) != rows(2)


def test_small_sizes_work(spark):
    assert synth.gen_all(synth.row_ids(spark, 3))["web_sessions"].count() == 3
    assert synth.gen_customers(spark.createDataFrame([(1234567,)], "i long")).first()["customer_id"] == "CUST1234568"
