"""Basket pairs by blocks."""

from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from stallkeeper.plans import features


def skewed(spark):
    """600 small baskets and one that holds a third of all lines."""
    small = spark.range(3000).select((F.col("id") % 600).alias("order_id"), (F.col("id") * 7919 % 1009).alias("product_id"))
    return small.unionByName(spark.range(1500).select(F.lit(9999).cast("bigint").alias("order_id"), F.col("id").alias("product_id"))).unionByName(small.limit(50))


def test_all_pairs_of_all_baskets(spark):
    items = skewed(spark)
    baskets: dict[int, set] = {}
    for r in items.collect():
        baskets.setdefault(r["order_id"], set()).add(r["product_id"])
    sold = Counter(p for b in baskets.values() for p in b)
    want = Counter(pair for b in baskets.values() for pair in combinations(sorted(p for p in b if sold[p] > 1), 2))
    got = {(r["anchor_id"], r["partner_id"]): r["together"] for r in features.copurchase_pairs(items, block=64).collect()}
    assert got == {k: n for (a, b), n in want.items() if n > 1 for k in ((a, b), (b, a))}


def test_a_large_basket_is_dealt_in_even_block_pairs(spark):
    left, right = features.block_pairs(features.basket_blocks(skewed(spark).distinct(), 64))
    work = left.groupBy("order_id", "i", "j").agg(F.count("*").alias("l")).join(right.groupBy("order_id", "i", "j").agg(F.count("*").alias("r")), ["order_id", "i", "j"])
    cells = sorted(r["l"] * r["r"] for r in work.filter("order_id = 9999").collect())
    assert len(cells) == 24 * 25 // 2 and cells[-1] <= 4 * cells[len(cells) // 2]
    assert cells[-1] < 1500 * 1500 / 100  # of the pairs of the basket in one task
