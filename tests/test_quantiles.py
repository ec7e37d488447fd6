"""Order statistics by range refinement against sorting."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators import quantiles
from stallkeeper.plans import quality

RNG = random.Random(11)
CASES = {
    "even": [i / 7 for i in range(1000)],
    "one value": [3.0] * 50,
    "hot value": [5.0] * 400 + [RNG.uniform(0, 10) for _ in range(600)],
    "far tail": [10.0 ** (i / 20) for i in range(400)],
    "negative": [RNG.gauss(-50, 30) for _ in range(500)] + [-1e12, 1e12],
    "two": [1.0, 2.0],
}


@pytest.mark.parametrize("name", CASES)
def test_ranks_are_exact(spark, name, monkeypatch):
    monkeypatch.setattr(quantiles, "RANGES", 16)  # many rounds
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(4)
    ranks = sorted({1, 2, len(values) // 4, len(values) // 2, len(values)} - {0})
    got = quantiles.at_ranks(df, "x", ranks, quantiles.cells(df, "x"))
    assert got == {r: sorted(values)[r - 1] for r in ranks}


def test_decimals_closer_than_doubles(spark):
    values = [Decimal("123456789012345678.0000") + Decimal(i) / 10000 for i in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(30,4)")
    assert quantiles.at_ranks(df, "x", [1, 20, 40], quantiles.cells(df, "x")) == {1: values[0], 20: values[19], 40: values[39]}


@pytest.mark.parametrize("kind", ["decimal(18,2)", "double"])
def test_places_of_outliers_in_the_whole_table(spark, kind):
    values = [round(RNG.gauss(100, 10), 2) for _ in range(900)] + [500.0] * 7 + [-300.0, -300.0, 900.0] + [100.0] * 300
    df = spark.createDataFrame(list(enumerate(values)), "order_id long, v double").select("order_id", F.col("v").cast(kind).alias("total_amount"))
    got = {int(r["record_id"]): r["percentile_rank"] for r in quality.outlier_detect(df, block_rows=3).collect()}
    below = {i: sum(w < v for w in values) / (len(values) - 1) for i, v in enumerate(values)}
    assert len(got) > 10 and got == pytest.approx({i: below[i] for i in got})


def test_only_outliers_are_put_in_order(spark):
    df = spark.range(2000).select(F.col("id").alias("order_id"), F.when(F.col("id") < 3, 1e6).otherwise(F.col("id") % 50).cast("decimal(18,2)").alias("total_amount"))
    out = quality.outlier_detect(df)
    assert out.count() == 3
    staged = [x for x in out.inputFiles() if "/ordered-" in x]
    assert staged and spark.read.parquet(*staged).count() == 3
