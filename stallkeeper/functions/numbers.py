"""Number conventions shared by all jobs.

Money is summed as exact decimals and published as double; averages are the
exact sum divided by the count, so the result does not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return as_col(c).cast("double")


def total(c: str | Column) -> Column:
    return dbl(F.sum(as_col(c)))


def mean(c: str | Column) -> Column:
    """Average of a decimal or integer column; NULL when there is no value."""
    return F.try_divide(dbl(F.sum(as_col(c))), dbl(F.count(as_col(c))))


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(dbl(num), dbl(den))


def pct(num: Column, den: Column) -> Column:
    """``num`` in percent of ``den``; NULL when ``den`` is zero."""
    return F.try_divide(dbl(num) * F.lit(100.0), dbl(den))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def label(cases: list[tuple[Column, str]], otherwise: str) -> Column:
    """First matching label, as a CASE chain."""
    (cond, value), *rest = cases
    chain = F.when(cond, value)
    for cond, value in rest:
        chain = chain.when(cond, value)
    return chain.otherwise(otherwise)

