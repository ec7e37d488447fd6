"""Typed data-quality rules, evaluated in one scan per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import count_if, dbl, pct
from ..functions.strings import EMAIL_PATTERN

PASS, FAIL, WARNING = "PASS", "FAIL", "WARNING"


@dataclass(frozen=True)
class Rule:
    """One check.  ``failed`` gives the failing condition of a row; uniqueness
    and referential rules use ``column`` (and ``parent``) instead."""

    rule_id: str
    table: str
    column: str
    rule_type: str
    definition: str
    threshold: float
    severity: str
    otherwise: str
    found: str
    clean: str
    failed: Column | None = field(default=None, compare=False)
    parent: tuple[str, str] | None = None


def email_invalid(c: str = "email") -> Column:
    return F.col(c).isNotNull() & ~F.col(c).rlike(EMAIL_PATTERN)


def standard_rules(variant: str = "v1") -> list[Rule]:
    """The shop's rule catalog; v2 also runs the referential rule.

    Fixed values: ids, definitions, thresholds and messages.
    """
    v2 = variant == "v2"
    matcher = "REGEXP" if v2 else "RLIKE"
    quoted = EMAIL_PATTERN.replace("\\", "\\\\")
    crit, warn = "CRITICAL", "WARNING"
    rules = [
        Rule("DQ001", "customers", "customer_id", "NULL_CHECK", "customer_id IS NOT NULL", 0.0, crit, FAIL,
             " null customer_id records", "No null values found", F.col("customer_id").isNull()),
        Rule("DQ002", "customers", "email", "FORMAT_CHECK", f'email {matcher} "{quoted}"', 5.0, warn, WARNING,
             " invalid email formats", "All email formats are valid", email_invalid()),
        Rule("DQ003", "customers", "customer_id", "UNIQUENESS_CHECK", "COUNT(customer_id) = COUNT(DISTINCT customer_id)",
             0.0, crit, FAIL, " duplicate customer_id records",
             "No duplicates found" if v2 else "All customer_id values are unique"),
        Rule("DQ004", "orders", "total_amount", "RANGE_CHECK", "total_amount > 0", 1.0, crit, FAIL,
             " orders with non-positive amounts", "All order amounts are positive", F.col("total_amount") <= 0),
        Rule("DQ005", "products", "price", "RANGE_CHECK", "price > cost", 2.0, warn, WARNING,
             " products where price <= cost" if v2 else " products with price <= cost",
             "All product prices are above cost" if v2 else "All product prices are greater than cost",
             F.col("price") <= F.col("cost")),
        Rule("DQ006", "orders", "customer_id", "REFERENTIAL_CHECK", "customer_id EXISTS IN customers", 0.0, crit, FAIL,
             " orders with invalid customer_id", "All orders have valid customer references",
             parent=("customers", "customer_id")),
    ]
    return rules


def active_rules(variant: str = "v1") -> list[Rule]:
    return [r for r in standard_rules(variant) if variant == "v2" or r.rule_type != "REFERENTIAL_CHECK"]


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The catalog as a table (one row per rule)."""
    rows = [(r.rule_id, r.table, r.column, r.rule_type, r.definition, r.threshold, r.severity, True) for r in rules]
    return spark.createDataFrame(
        rows, "rule_id string, table_name string, column_name string, rule_type string, rule_definition string, "
        "threshold_value double, severity string, active boolean")


def assess_table(df: DataFrame, rules: list[Rule], tables: dict[str, DataFrame], by: list[str] | None = None) -> DataFrame:
    """Results of all ``rules`` of one table, optionally per value of ``by``."""
    by = by or []
    refs = [r for r in rules if r.parent]
    uniques = [r for r in rules if r.rule_type == "UNIQUENESS_CHECK"]
    if refs and (uniques or len(refs) > 1):
        # a referential rule regroups the table by its key; give it its own pass
        parts = [assess_table(df, [r], tables, by) for r in refs]
        parts.append(assess_table(df, [r for r in rules if not r.parent], tables, by))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    row_counts = [count_if(r.failed).alias(r.rule_id) for r in rules if r.failed is not None]
    if refs:
        ref = refs[0]
        parent_table, parent_key = ref.parent
        parents = tables[parent_table].select(F.col(parent_key).alias(ref.column)).distinct().withColumn("_hit", F.lit(True))
        # one row per key and map task: a hot key costs nothing in the join
        slim = df.groupBy(*by, ref.column).agg(F.count("*").alias("_n"), *row_counts).join(parents, ref.column, "left")
        sums = [F.sum(r.rule_id).alias(r.rule_id) for r in rules if r.failed is not None]
        missing = F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).alias(ref.rule_id)
        wide = slim.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"), missing, *sums)
    else:
        dups = [(F.count("*") - F.countDistinct(r.column)).alias(r.rule_id) for r in uniques]
        wide = df.groupBy(*by).agg(F.count("*").alias("_total"), *row_counts, *dups)
    results = [_result(r) for r in rules]
    return wide.select(*by, F.explode(F.array(*results)).alias("r")).select("r.*", *by)


def _result(r: Rule) -> Column:
    failed, n = F.coalesce(F.col(r.rule_id), F.lit(0)).cast("bigint"), F.col("_total")
    rate = pct(failed, n)
    status = F.when((failed == 0) | (rate <= r.threshold), PASS).otherwise(r.otherwise)
    text = F.when(failed > 0, F.concat(F.lit("Found "), failed.cast("string"), F.lit(r.found))).otherwise(r.clean)
    return F.struct(
        F.lit(r.rule_id).alias("rule_id"), F.lit(r.table).alias("table_name"), F.lit(r.column).alias("column_name"),
        F.lit(r.rule_type).alias("rule_type"), n.alias("total_records"), failed.alias("failed_records"),
        rate.alias("failure_rate"), F.lit(r.threshold).alias("threshold_value"), status.alias("status"),
        F.lit(r.severity).alias("severity"), text.alias("error_details"),
    )


def assess(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Assessment of all rules: the rules of one table share a scan."""
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    parts = [assess_table(tables[t], rs, tables) for t, rs in by_table.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def score(passed: Column, n: Column) -> Column:
    return F.round(dbl(passed) * 100.0 / dbl(n), 2)
