"""Expectations of tables, given as rows by the caller and evaluated in one pass for each table.

An expectation names a table, a kind, a subject and a bound:

=============  ========================================  ==========================================
kind           subject                                   holds if
=============  ========================================  ==========================================
rows           --                                        the table has exactly ``expected`` rows
rows_at_least  --                                        it has ``expected`` rows or more
matching       a SQL condition                           exactly ``expected`` rows meet it
some           a SQL condition                           ``expected`` rows or more meet it
share          a SQL condition                           that share of the rows, or more, meets it
in_set         a column                                  all values but ``expected`` rows are among ``values``
distinct       a column                                  it has exactly ``expected`` different values
reference      a column                                  exactly ``expected`` rows have no partner in ``parent`` (table.column)
=============  ========================================  ==========================================

All but the last two are plain counts: ``measures`` gives them as aggregates, for a scan of the table or to be observed while it is
written.  A null never meets a condition, is in no set and has no partner.  The share of an empty table is null and fails.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import count_if

KINDS = ("rows", "rows_at_least", "matching", "some", "share", "in_set", "distinct", "reference")
PLAIN = KINDS[:6]
ROWS = ("label string, table_name string, kind string, subject string, expected double, `values` array<string>, parent string")


@dataclass(frozen=True)
class Expectation:
    label: str
    table: str
    kind: str
    subject: str | None = None
    expected: float = 0.0
    values: tuple[str, ...] = ()
    parent: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"{self.label}: no kind {self.kind}")
        if (self.subject is None) != (self.kind in KINDS[:2]) or (self.parent is None) == (self.kind == "reference"):
            raise ValueError(f"{self.label}: subject or parent does not fit {self.kind}")

    @property
    def reaches(self) -> bool:
        """More than expected is good as well."""
        return self.kind in ("rows_at_least", "some", "share")


def as_rows(spark: SparkSession, expectations: Iterable[Expectation]) -> DataFrame:
    return spark.createDataFrame([(e.label, e.table, e.kind, e.subject, float(e.expected), list(e.values), e.parent) for e in expectations], ROWS)


def from_rows(rows: DataFrame) -> list[Expectation]:
    """A stored catalog, one row for each check."""
    return [Expectation(r["label"], r["table_name"], r["kind"], r["subject"], r["expected"], tuple(r["values"] or ()), r["parent"])
            for r in rows.select("label", "table_name", "kind", "subject", "expected", "values", "parent").collect()]


def broken(e: Expectation) -> Column:
    """Condition of the rows that speak against a row-wise expectation."""
    if e.kind == "in_set":
        return ~F.coalesce(F.col(e.subject).cast("string").isin(list(e.values)), F.lit(False))
    return F.coalesce(F.expr(e.subject), F.lit(False)) if e.kind == "matching" else ~F.coalesce(F.expr(e.subject), F.lit(False))


def _measure(e: Expectation) -> Column:
    n = F.count(F.lit(1))
    if e.kind in ("rows", "rows_at_least"):
        return n.cast("double")
    if e.kind == "in_set":
        return count_if(broken(e)).cast("double")
    met = count_if(F.coalesce(F.expr(e.subject), F.lit(False))).cast("double")
    return F.try_divide(met, n.cast("double")) if e.kind == "share" else met


def plain(expectations: Iterable[Expectation], table: str) -> list[Expectation]:
    return [e for e in expectations if e.table == table and e.kind in PLAIN]


def measures(expectations: Iterable[Expectation], table: str) -> list[Column]:
    """One aggregate for each plain expectation of ``table``, named by its place ``e0``, ``e1``, ..."""
    return [_measure(e).alias(f"e{i}") for i, e in enumerate(plain(expectations, table))]


def holds(e: Expectation, actual: float | None) -> bool:
    return actual is not None and (actual >= e.expected if e.reaches else actual == e.expected)


def _result(e: Expectation, actual: Column) -> Column:
    ok = actual >= e.expected if e.reaches else actual == e.expected
    return F.struct(F.lit(e.label).alias("label"), F.lit(e.table).alias("table_name"), F.lit(e.kind).alias("kind"),
                    F.lit(float(e.expected)).alias("expected"), actual.alias("actual"),
                    F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"))


def _without_partner(e: Expectation, tables: dict[str, DataFrame]) -> DataFrame:
    """(key, rows) without partner; keys are counted first, so a key with many rows is one in the join."""
    table, column = e.parent.rsplit(".", 1)
    keys = tables[e.table].groupBy(F.col(e.subject).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(tables[table].select(F.col(column).alias("key")).distinct(), "key", "left_anti")


def evaluate(tables: dict[str, DataFrame], expectations: list[Expectation]) -> DataFrame:
    """(label, table_name, kind, expected, actual, status): one aggregate for each table, one for its distinct values, one join for each reference."""
    parts = []
    for table in dict.fromkeys(e.table for e in expectations):
        own = [e for e in expectations if e.table == table]
        counted = plain(own, table)
        if counted:
            row = tables[table].agg(*measures(own, table))
            parts.append(row.select(F.explode(F.array(*[_result(e, F.col(f"e{i}")) for i, e in enumerate(counted)])).alias("r")).select("r.*"))
        different = [e for e in own if e.kind == "distinct"]
        if different:
            row = tables[table].agg(*[F.countDistinct(e.subject).cast("double").alias(f"d{i}") for i, e in enumerate(different)])
            parts.append(row.select(F.explode(F.array(*[_result(e, F.col(f"d{i}")) for i, e in enumerate(different)])).alias("r")).select("r.*"))
        for e in own:
            if e.kind == "reference":
                lost = _without_partner(e, tables).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("double").alias("n"))
                parts.append(lost.select(_result(e, F.col("n")).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed(spark: SparkSession, expectations: list[Expectation], seen: dict[str, dict]) -> DataFrame:
    """The same rows for plain expectations whose ``measures`` were observed while their tables were written."""
    rows = [(e.label, table, e.kind, float(e.expected), values[f"e{i}"], "PASS" if holds(e, values[f"e{i}"]) else "FAIL")
            for table, values in seen.items() for i, e in enumerate(plain(expectations, table))]
    return spark.createDataFrame(rows, "label string, table_name string, kind string, expected double, actual double, status string")


def failing_rows(tables: dict[str, DataFrame], expectations: list[Expectation], keys: dict[str, str]) -> DataFrame:
    """(label, table_name, row_key, failing): every row that speaks against a row-wise expectation, all checks of a table in one scan.

    Of a reference, the keys without partner with the number of their rows; of ``keys[table]`` otherwise.
    """
    parts = []
    for table in dict.fromkeys(e.table for e in expectations):
        own = [e for e in expectations if e.table == table and e.kind in ("matching", "share", "in_set")]
        if own:
            marks = F.array_compact(F.array(*[F.when(broken(e), F.lit(e.label)) for e in own]))
            parts.append(tables[table].select(F.explode(marks).alias("label"), F.lit(table).alias("table_name"),
                                              F.col(keys[table]).cast("string").alias("row_key"), F.lit(1).cast("bigint").alias("failing")))
        for e in expectations:
            if e.table == table and e.kind == "reference":
                parts.append(_without_partner(e, tables).select(
                    F.lit(e.label).alias("label"), F.lit(table).alias("table_name"), F.col("key").cast("string").alias("row_key"), F.col("rows").alias("failing")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
