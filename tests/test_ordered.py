"""Blocked global windows against the plain single-partition window."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from stallkeeper.operators.ordered import (
    ntile, number_rows, percent_rank, running_and_neighbours, with_ranks, with_running_sum,
)


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, v long")


def plain_ranks(df):
    order, ties = Window.orderBy(F.desc("v"), "id"), Window.orderBy(F.desc("v"))
    return {r["id"]: (r["rn"], r["rk"], r["dr"], r["nt"], r["pr"]) for r in df.select(
        "id", F.row_number().over(order).alias("rn"), F.rank().over(ties).alias("rk"), F.dense_rank().over(ties).alias("dr"),
        F.ntile(4).over(order).alias("nt"), F.percent_rank().over(ties).alias("pr")).collect()}


def blocked_ranks(df, block_rows):
    o = number_rows(df, [F.desc("v"), F.asc("id")], **({"block_rows": block_rows} if block_rows else {}))
    rows = with_ranks(o, "v").select("id", "rn", "rank", "dense_rank", ntile(o.n, 4, F.col("rn")).alias("nt"),
                                     percent_rank(o.n, F.col("rank")).alias("pr")).collect()
    return {r["id"]: (r["rn"], r["rank"], r["dense_rank"], r["nt"], r["pr"]) for r in rows}


@pytest.mark.parametrize("values,block_rows", [
    ([5, 5, 5, 5, 5, 5, 5], 2),                      # one key over all blocks
    ([1, 2, 2, 2, 2, 2, 3, 3, 1, 9], 3),
    ([7] * 40 + [3] * 5 + list(range(20)), 4),       # a key with most of the rows
    ([None, None, 4, 4, None, 1], 2), ([1], 1), ([2, 1], 5), ([], 3),
])
def test_ranks_match_plain_window(spark, values, block_rows):
    df = frame(spark, values)
    assert blocked_ranks(df, block_rows) == blocked_ranks(df, None) == plain_ranks(df)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 6), min_size=1, max_size=60), st.integers(1, 9))
def test_ranks_property(spark, values, block_rows):
    df = frame(spark, values)
    assert blocked_ranks(df, block_rows) == plain_ranks(df)


@pytest.mark.parametrize("n,block_rows", [(1, 2), (2, 2), (7, 2), (25, 3), (60, 7)])
def test_running_and_neighbours(spark, n, block_rows):
    rng = random.Random(n)
    values = [rng.choice([None, 1, 2, 3, 50]) for _ in range(n)]
    df = frame(spark, values)
    w = Window.orderBy("id")
    want = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.avg("v").over(w.rowsBetween(-2, 0)),
                     F.lag("v").over(w), F.lead("v").over(w)).collect()
    got = running_and_neighbours(number_rows(df, [F.asc("id")], block_rows), "v", "run", "mov", 3, "prev", "nxt").select(
        "id", "run", "mov", "prev", "nxt").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == sorted(map(tuple, want), key=lambda r: r[0])
    small = running_and_neighbours(number_rows(df, [F.asc("id")]), "v", "run", "mov", 3, "prev", "nxt")
    rows = small.select("id", "run", "mov", "prev", "nxt").collect()
    assert sorted(rows, key=lambda r: r[0]) == sorted(got, key=lambda r: r[0])


def test_running_sum_only(spark):
    df = frame(spark, [3, 1, 4, 1, 5, 9, 2, 6])
    out = with_running_sum(number_rows(df, [F.asc("id")], 3), "v", "s").orderBy("id").collect()
    assert [r["s"] for r in out] == [3, 4, 8, 9, 14, 23, 25, 31]


def test_block_shorter_than_frame_is_refused(spark):
    with pytest.raises(ValueError):
        running_and_neighbours(number_rows(frame(spark, [1, 2, 3]), [F.asc("id")], 1), "v", "a", "b", 3, "c", "d")
