"""Ranks, running totals and neighbour values over one global order.

``Window.orderBy`` without partitions moves the whole table into one task.
Here rows are range-partitioned and numbered once, then every window runs on
blocks of consecutive row numbers, all of the same fixed length whatever the
size of the table.  Only the block summaries are ordered in one place and
broadcast back: one short row for each 200,000 rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..session import shuffle_width, stage

# monotonically_increasing_id keeps the partition number above this bit
_POSITION_BITS = 33
BLOCK_ROWS = 200_000


@dataclass(frozen=True)
class OrderedRows:
    """Rows with a gap-free global number ``rn`` (from 1)."""

    rows: DataFrame
    placed: DataFrame
    block_rows: int

    @cached_property
    def n(self) -> int:
        """Rows of the staged table, counted from its file footers when asked for."""
        return self.placed.count()

    def blocked(self) -> DataFrame:
        return self.rows.withColumn("_block", F.floor((F.col("rn") - 1) / self.block_rows).cast("long"))


def number_rows(df: DataFrame, order: list[Column], block_rows: int = BLOCK_ROWS) -> OrderedRows:
    """Number ``df`` by ``order``, which must end in a unique key.

    The unique tail lets the range partitioner split even a single sort value
    that fills a large part of the table.
    """
    spark = df.sparkSession
    width = shuffle_width(spark)
    placed = stage(
        df.repartitionByRange(width, *order).sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_bucket", F.shiftright("_pos", _POSITION_BITS))
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # one row per range bucket, so this window and the broadcast stay small
    before = sizes.select(
        "_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before")
    )
    rows = (
        placed.join(F.broadcast(before), "_bucket")
        .withColumn("rn", F.col("_before") + F.col("_pos").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)) + 1)
        .drop("_bucket", "_before", "_pos")
    )
    return OrderedRows(rows, placed, block_rows)


def _key_groups(rows: DataFrame, key: str, local: WindowSpec) -> DataFrame:
    """First row number of each run of equal keys and the run's number."""
    fresh = F.lag("rn").over(local).isNull() | ~F.lag(key).over(local).eqNullSafe(F.col(key))
    rows = rows.withColumn("_start", F.when(fresh, F.col("rn"))).withColumn("_first", fresh.cast("long"))
    return rows.withColumn("_start", F.max("_start").over(local)).withColumn("_dense", F.sum("_first").over(local))


def with_ranks(ordered: OrderedRows, key: str, rank: str = "rank", dense: str = "dense_rank") -> DataFrame:
    """Add RANK and DENSE_RANK of ``key``, the leading sort column.

    A group of equal keys may span many blocks; the block summary carries the
    group's first row number and the distinct-key count forward.
    """
    rows = _key_groups(ordered.blocked(), key, Window.partitionBy("_block").orderBy("rn"))

    summary = rows.groupBy("_block").agg(
        F.min_by(key, "rn").alias("_key0"), F.max_by(key, "rn").alias("_key1"),
        F.max("_start").alias("_last_start"), F.max("_dense").alias("_keys"),
    )
    blocks = Window.orderBy("_block")  # block summaries only
    summary = summary.withColumn(
        "_joins", F.lag("_block").over(blocks).isNotNull() & F.lag("_key1").over(blocks).eqNullSafe(F.col("_key0"))
    )
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn(
        "_open", F.when(F.col("_joins") & (F.col("_keys") == 1), None).otherwise(F.col("_last_start"))
    ).withColumn("_new_keys", F.col("_keys") - F.col("_joins").cast("long"))
    summary = summary.select(
        "_block", "_joins",
        F.last("_open", ignorenulls=True).over(earlier).alias("_carry"),
        (F.coalesce(F.sum("_new_keys").over(earlier), F.lit(0)) - F.col("_joins").cast("long")).alias("_dense0"),
    )
    out = rows.join(F.broadcast(summary), "_block")
    return (
        out.withColumn(rank, F.when(F.col("_joins") & (F.col("_dense") == 1), F.col("_carry")).otherwise(F.col("_start")))
        .withColumn(dense, F.col("_dense0") + F.col("_dense"))
        .drop("_block", "_start", "_first", "_dense", "_joins", "_carry", "_dense0")
    )


def ntile(n: int, k: int, rn: Column) -> Column:
    """NTILE(k) of ``n`` rows from the row number."""
    size, extra = divmod(n, k)
    cut = extra * (size + 1)
    big = F.floor((rn - 1) / (size + 1)) + 1
    if size == 0:
        return big.cast("int")
    small = F.floor((rn - 1 - cut) / size) + 1 + extra
    return F.when(rn <= cut, big).otherwise(small).cast("int")


def percent_rank(n: int, rank: Column) -> Column:
    if n <= 1:
        return F.lit(0.0)
    return (rank - 1).cast("double") / F.lit(float(n - 1))


def with_running_sum(ordered: OrderedRows, value: str, out: str) -> DataFrame:
    """Add the running sum of ``value`` in row-number order."""
    rows = ordered.blocked()
    return _running(rows, value, out, F.lit(True)).drop("_block")


def _running(rows: DataFrame, value: str, out: str, own: Column, part: str = "_block") -> DataFrame:
    sums = rows.filter(own).groupBy(F.col(part).alias("_b")).agg(F.sum(value).alias("_s"))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_b", F.sum("_s").over(earlier).alias("_offset"))
    local = Window.partitionBy(part).orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_local", F.sum(F.when(own, F.col(value))).over(local))
    joined = rows.join(F.broadcast(offsets), rows[part] == offsets["_b"])
    filled = F.when(F.col("_local").isNull() & F.col("_offset").isNull(), None).otherwise(
        F.coalesce("_local", F.lit(0)) + F.coalesce("_offset", F.lit(0))
    )
    return joined.withColumn(out, filled).drop("_b", "_offset", "_local")


def with_neighbours(ordered: OrderedRows, back: int, ahead: int) -> DataFrame:
    """Rows placed in their block and, near an edge, also in the next one.

    Adds ``_home`` (block the copy serves) and ``_own`` (false for an edge
    copy).  A frame of up to ``back`` rows before and ``ahead`` rows after is
    complete within ``_home``; drop the edge copies afterwards.
    """
    if ordered.block_rows < max(back, ahead, 1):
        raise ValueError("blocks must be at least as long as the frame")
    rows = ordered.blocked()
    pos = (F.col("rn") - 1) % ordered.block_rows
    homes = F.array(
        F.col("_block"),
        F.when(pos >= ordered.block_rows - back, F.col("_block") + 1),
        F.when((pos < ahead) & (F.col("_block") > 0), F.col("_block") - 1),
    )
    return (
        rows.withColumn("_home", F.explode(F.array_compact(homes)))
        .withColumn("_own", F.col("_home") == F.col("_block"))
    )


def with_next(ordered: OrderedRows, value: Column, out: str) -> DataFrame:
    """Add ``value`` of the following row."""
    near = with_neighbours(ordered, back=0, ahead=1)
    near = near.withColumn(out, F.lead(value).over(Window.partitionBy("_home").orderBy("rn")))
    return near.filter("_own").drop("_home", "_own", "_block")


def running_and_neighbours(ordered: OrderedRows, value: str, running: str, moving: str,
                           moving_rows: int, prev: str, nxt: str) -> DataFrame:
    """Running sum, moving average, previous and next value in one pass."""
    rows = with_neighbours(ordered, back=moving_rows - 1, ahead=1)
    local = Window.partitionBy("_home").orderBy("rn")
    frame = local.rowsBetween(-(moving_rows - 1), 0)
    rows = rows.select(
        "*", F.lag(value, 1).over(local).alias(prev), F.lead(value, 1).over(local).alias(nxt),
        F.try_divide(F.sum(value).over(frame).cast("double"), F.count(value).over(frame).cast("double")).alias(moving),
    )
    rows = _running(rows, value, running, F.col("_own"), part="_home")
    return rows.filter("_own").drop("_home", "_own", "_block")
