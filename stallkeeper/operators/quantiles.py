"""Exact order statistics without ordering the table.

The rows are counted by range of their value; only the ranges that hold an asked-for rank are counted again, by finer ranges, until a range
holds one value.  Each pass reads one column, keeps a bounded number of counts and narrows a range by RANGES, so two or three passes
suffice for most tables, and a value that fills a large part of it ends the search at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

RANGES = 4096


@dataclass(frozen=True)
class _Range:
    """Closed range of values and the number of rows below it."""

    low: object
    high: object
    below: int


@dataclass(frozen=True)
class Cells:
    """A table's values in coarse ranges that rise with the values: (rows, smallest, largest) of each, and totals of the whole table."""

    ranges: list[tuple[int, object, object]]
    totals: Row

    @property
    def n(self) -> int:
        return sum(r[0] for r in self.ranges)

    def range_of(self, rank: int) -> _Range:
        below = 0
        for n, low, high in self.ranges:
            if below + n >= rank:
                return _Range(low, high, below)
            below += n
        raise ValueError(f"no rank {rank}")


def cells(df: DataFrame, value: str, *totals: Column) -> Cells:
    """One pass: values counted by the logarithm of their size, at most some ten thousand cells, beside ``totals`` of all rows."""
    d = F.col(value).cast("double")
    cell = (F.signum(d) * F.floor(F.log1p(F.abs(d)) * 64)).cast("int")
    rows = df.filter(F.col(value).isNotNull()).select("*", cell.alias("_cell")).rollup("_cell").agg(
        F.grouping("_cell").alias("_whole"), F.count(F.lit(1)).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"), *totals).collect()
    parts = sorted((r for r in rows if not r["_whole"]), key=lambda r: r["_cell"])
    return Cells([(r["_n"], r["_low"], r["_high"]) for r in parts], next((r for r in rows if r["_whole"]), None))


def at_ranks(df: DataFrame, value: str, ranks: list[int], known: Cells) -> dict[int, object]:
    """The values at 1-based ``ranks`` of the non-null values in ascending order."""
    kind = df.schema[value].dataType
    x = F.col(value)
    open_ = {r: known.range_of(r) for r in ranks}
    found: dict[int, object] = {}
    while True:
        found |= {r: s.low for r, s in open_.items() if s.low == s.high}
        open_ = {r: s for r, s in open_.items() if r not in found}
        if not open_:
            return found
        spans = list(dict.fromkeys(open_.values()))
        part, near_rows = F.lit(None).cast("bigint"), F.lit(False)
        for i, s in enumerate(spans):
            inside = (x >= F.lit(s.low).cast(kind)) & (x <= F.lit(s.high).cast(kind))
            if float(s.low) == float(s.high):  # too near for doubles: value by value
                cell = F.lit(0)
            else:
                cell = F.width_bucket(x.cast("double"), F.lit(float(s.low)), F.lit(float(s.high)), F.lit(RANGES))
            near_rows |= inside
            part = F.when(inside, F.lit(i * (RANGES + 2)).cast("bigint") + cell).otherwise(part)
        near = [i for i, s in enumerate(spans) if float(s.low) == float(s.high)]
        exact = F.when(F.floor(F.col("part") / (RANGES + 2)).isin(near), F.col("x")) if near else F.lit(None).cast(kind)
        counts = df.filter(near_rows).select(x.alias("x"), part.alias("part")).groupBy("part", exact.alias("one")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        cells: dict[int, list] = {}
        for c in sorted(counts, key=lambda c: (c["part"], c["low"])):
            cells.setdefault(c["part"] // (RANGES + 2), []).append(c)
        for rank, s in open_.items():
            below = s.below
            for c in cells[spans.index(s)]:
                if below + c["n"] >= rank:
                    open_[rank] = _Range(c["low"], c["high"], below)
                    break
                below += c["n"]
