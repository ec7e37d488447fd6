"""Data quality: assessment, profile, cleansing, outliers, reports and alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import count_if, dbl, label, mean, pct, ratio
from ..functions.strings import EMAIL_PATTERN
from ..operators.ordered import BLOCK_ROWS, number_rows, percent_rank, with_ranks
from ..operators.quantiles import at_ranks, cells
from ..operators.rules import Rule, active_rules, assess, assess_table, score, standard_rules
from ..session import stage

# Spellings folded into one country name.
COUNTRY_ALIASES = {
    "USA": ["US", "USA", "UNITED STATES"],
    "UK": ["UK", "UNITED KINGDOM", "BRITAIN"],
    "China": ["CHINA", "CN"],
    "Canada": ["CANADA", "CA"],
}


# ---- assessment ----------------------------------------------------------

def dq_check(rule_id: str, tables: dict[str, DataFrame], variant: str = "v2") -> DataFrame:
    rule = next(r for r in standard_rules(variant) if r.rule_id == rule_id)
    return assess_table(tables[rule.table], [rule], tables)


def dq_assessment(tables: dict[str, DataFrame], ds: str, variant: str = "v1") -> DataFrame:
    return assess(tables, active_rules(variant)).withColumn("ds", F.lit(ds))


def dq_assessment_by_day(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Assessment of one partitioned table for each of its ``ds`` values."""
    return assess_table(df, rules, {}, by=["ds"])


def session_rules() -> list[Rule]:
    """Daily checks on web sessions, used to show a trend over days."""
    return [
        Rule("WS001", "web_sessions", "session_id", "NULL_CHECK", "session_id IS NOT NULL", 0.0, "CRITICAL", "FAIL",
             " null session_id records", "No null values found", F.col("session_id").isNull()),
        Rule("WS002", "web_sessions", "page_views", "RANGE_CHECK", "page_views > 1", 28.0, "WARNING", "WARNING",
             " single-page sessions", "No single-page sessions", F.col("page_views") <= 1),
        Rule("WS003", "web_sessions", "session_id", "UNIQUENESS_CHECK", "session_id is unique", 0.0, "CRITICAL", "FAIL",
             " duplicate session_id records", "All session_id values are unique"),
    ]


# ---- profile -------------------------------------------------------------

@dataclass(frozen=True)
class ColumnProfile:
    name: str
    data_type: str = "STRING"
    numeric: bool = False
    bounds: bool = True


def data_profile(df: DataFrame, table: str, columns: list[ColumnProfile]) -> DataFrame:
    """One row per column, all columns measured in one aggregation."""
    aggs: list[Column] = [F.count("*").alias("n")]
    for i, c in enumerate(columns):
        x = F.col(c.name)
        aggs += [F.count(x).alias(f"c{i}"), F.countDistinct(x).alias(f"d{i}"),
                 F.min(x).cast("string").alias(f"lo{i}"), F.max(x).cast("string").alias(f"hi{i}")]
        if c.numeric:
            aggs += [F.sum(x).alias(f"s{i}"), F.stddev_samp(dbl(x)).alias(f"q{i}")]
    rows = []
    for i, c in enumerate(columns):
        nulls = F.col("n") - F.col(f"c{i}")
        none, num = F.lit(None).cast("string"), F.lit(None).cast("double")
        rows.append(F.struct(
            F.lit(c.name).alias("column_name"), F.lit(c.data_type).alias("data_type"), F.col("n").alias("total_records"),
            nulls.alias("null_count"), pct(nulls, F.col("n")).alias("null_percentage"),
            F.col(f"d{i}").alias("distinct_count"),
            (F.col(f"lo{i}") if c.bounds else none).alias("min_value"),
            (F.col(f"hi{i}") if c.bounds else none).alias("max_value"),
            (ratio(F.col(f"s{i}"), F.col(f"c{i}")) if c.numeric else num).alias("avg_value"),
            (F.col(f"q{i}") if c.numeric else num).alias("std_dev"),
        ))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select(F.lit(table).alias("table_name"), "r.*")


def shop_profile(customers: DataFrame, orders: DataFrame, variant: str = "v1") -> DataFrame:
    people = data_profile(customers, "customers", [
        ColumnProfile("customer_id"), ColumnProfile("email", bounds=variant == "v1")])
    return people.unionByName(data_profile(orders, "orders", [ColumnProfile("total_amount", "DOUBLE", numeric=True)]))


# ---- cleansing -----------------------------------------------------------

def cleanse_email(c: str = "email") -> Column:
    """Lower-cased address when valid as it stands, else NULL."""
    return F.when(F.col(c).rlike(EMAIL_PATTERN), F.lower(F.trim(c)))


def cleanse_phone(c: str = "phone") -> Column:
    """Digits behind ``+1-``; foreign prefixes are kept behind it too."""
    return F.regexp_replace(F.regexp_replace(c, "[^0-9+]", ""), r"^\+?1?", "+1-")


def standardize_country(c: str = "country") -> Column:
    key = F.upper(F.trim(c))
    return label([(key.isin(spellings), name) for name, spellings in COUNTRY_ALIASES.items()], F.trim(c))


def customers_clean(customers: DataFrame) -> DataFrame:
    city = F.trim(F.initcap("city"))
    flags = F.concat_ws(
        "|",
        F.when(F.col("email") != F.lower(F.trim("email")), "EMAIL_FORMATTED"),
        F.when(F.col("email").isNotNull() & ~F.col("email").rlike(EMAIL_PATTERN), "EMAIL_INVALID"),
        F.when(F.col("phone") != cleanse_phone(), "PHONE_FORMATTED"),
        F.when(F.col("country") != F.trim("country"), "COUNTRY_TRIMMED"),
        F.when(F.col("city") != city, "CITY_FORMATTED"),
    )
    return customers.select(
        "customer_id", F.trim("first_name").alias("first_name"), F.trim("last_name").alias("last_name"),
        "email", cleanse_email().alias("email_clean"), "phone", cleanse_phone().alias("phone_clean"),
        F.col("registration_date").cast("string").alias("registration_date"),
        "country", standardize_country().alias("country_clean"), "city", city.alias("city_clean"), "age_group",
        flags.alias("cleansing_flags"),
    )


# ---- outliers ------------------------------------------------------------

def _stats(picked: DataFrame, value: str) -> DataFrame:
    """One row: count, mean, deviation, exact interpolated quartiles and fences; the quartiles by range refinement."""
    x, kind = F.col(value), picked.schema[value].dataType
    known = cells(picked, value, ratio(F.sum(x), F.count(x)).alias("m"), F.stddev_samp(dbl(value)).alias("s"))
    n, at, picks = known.n, {}, {}
    mean_, deviation = (known.totals["m"], known.totals["s"]) if n else (None, None)
    places = {name: divmod(quarter * max(n - 1, 0), 4) for name, quarter in (("q1", 1), ("q3", 3))}
    if n:
        at = at_ranks(picked, value, sorted({min(k, n) for whole, _ in places.values() for k in (whole + 1, whole + 2)}), known)
    for name, (whole, rest) in places.items():
        low, high = (F.lit(at.get(min(k, n))).cast(kind) for k in (whole + 1, whole + 2))
        picks[name] = (low + (high - low) * F.lit(rest) / F.lit(4)).cast("decimal(28,10)").alias(name)
    row = picked.sparkSession.range(1).select(
        F.lit(n).cast("bigint").alias("n"), F.lit(mean_).cast("double").alias("mean_value"), F.lit(deviation).cast("double").alias("stddev_value"), *picks.values())
    width = (F.col("q3") - F.col("q1")) * F.lit(1.5).cast("decimal(2,1)")
    return row.select("*", (F.col("q1") - width).alias("lower_fence"), (F.col("q3") + width).alias("upper_fence"))


def outlier_stats(orders: DataFrame, key: str = "order_id", value: str = "total_amount") -> DataFrame:
    stats = _stats(orders.filter(F.col(value).isNotNull()).select(key, value), value)
    return stats.select(F.col("n").alias("total_records"), F.round("mean_value", 6).alias("mean_amount"),
                        F.round("stddev_value", 6).alias("stddev_amount"),
                        *[F.round(dbl(c), 6).alias(c) for c in ("q1", "q3", "lower_fence", "upper_fence")])


def outlier_detect(orders: DataFrame, key: str = "order_id", value: str = "total_amount", table: str = "orders",
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows far from the mean or outside the quartile fences.

    Only these rows are put in order: what lies below a low outlier and above a high one are outliers too, so their places
    in the table follow from their places among the outliers and the number of rows between.
    """
    picked = orders.filter(F.col(value).isNotNull()).select(key, value)
    st = _stats(picked, value).first()
    known = lambda c, kind: F.lit(st[c]).cast(kind)
    x, lo, hi = F.col(value), known("lower_fence", "decimal(38,10)"), known("upper_fence", "decimal(38,10)")
    z = F.try_divide(dbl(value) - known("mean_value", "double"), known("stddev_value", "double"))
    outside = (x > hi) | (x < lo)
    tails = stage(picked.withColumn("z", z).filter((F.abs("z") > 2) | outside), "tails")
    ordered = number_rows(tails, [F.asc(value), F.asc(key)], block_rows)
    low = (x < lo) | F.coalesce(F.col("z") < -2, F.lit(False))
    place = F.when(low, F.col("rank")).otherwise(F.col("rank") + F.lit(st["n"] - ordered.n))
    bound = lambda c: F.round(c, 2).cast("decimal(28,2)").cast("string")
    return with_ranks(ordered, value).select(
        F.lit(table).alias("table_name"), F.lit(value).alias("column_name"),
        F.col(key).cast("string").alias("record_id"), x.cast("string").alias("value_found"),
        label([(F.abs("z") > 3, "STATISTICAL"), (outside, "IQR_OUTLIER")], "BUSINESS_RULE").alias("outlier_type"),
        F.round("z", 6).alias("z_score"), percent_rank(st["n"], place).alias("percentile_rank"),
        F.concat(F.lit("Expected range: "), bound(lo), F.lit(" - "), bound(hi)).alias("expected_range"),
        F.lit("Z-Score and IQR Analysis").alias("detection_method"),
        label([(F.abs("z") > 3, "HIGH"), (F.abs("z") > 2, "MEDIUM")], "LOW").alias("severity"))


# ---- reports over an assessment ------------------------------------------

def dq_score_by_table(assessment: DataFrame, ds: str) -> DataFrame:
    status = F.col("status")
    return assessment.filter(F.col("ds") == ds).groupBy("table_name").agg(
        F.count("*").alias("total_rules"), count_if(status == "PASS").alias("passed_rules"),
        count_if(status == "FAIL").alias("failed_rules"), count_if(status == "WARNING").alias("warning_rules"),
        score(count_if(status == "PASS"), F.count("*")).alias("quality_score_pct"),
    ).orderBy(F.desc("quality_score_pct"), "table_name")


def dq_trend(assessment: DataFrame, ds: str, days: int = 7) -> DataFrame:
    since = F.date_format(F.date_sub(F.to_date(F.lit(ds), "yyyyMMdd"), days), "yyyyMMdd")
    passed = count_if(F.col("status") == "PASS")
    return assessment.filter(F.col("ds") >= since).groupBy("ds").agg(
        F.count("*").alias("total_checks"), passed.alias("passed_checks"),
        score(passed, F.count("*")).alias("daily_quality_score"),
    ).orderBy("ds")


def _critical(assessment: DataFrame, ds: str) -> DataFrame:
    return assessment.filter((F.col("ds") == ds) & (F.col("severity") == "CRITICAL") & (F.col("status") == "FAIL"))


def dq_critical_issues(assessment: DataFrame, ds: str) -> DataFrame:
    return _critical(assessment, ds).select(
        "rule_id", "table_name", "column_name", "rule_type", "failed_records", "failure_rate", "error_details"
    ).orderBy(F.desc("failure_rate"), "rule_id")


def dq_alerts(assessment: DataFrame, ds: str, min_rate: float = 5.0) -> DataFrame:
    return _critical(assessment, ds).filter(F.col("failure_rate") > min_rate).select(
        F.lit("CRITICAL DATA QUALITY ALERT").alias("alert_type"),
        F.concat(F.lit("Table: "), "table_name", F.lit(", Column: "), "column_name").alias("affected_object"),
        F.col("error_details").alias("issue_description"),
        F.concat(F.col("failure_rate").cast("string"), F.lit("% failure rate")).alias("severity_info"),
        F.lit("Immediate action required").alias("recommendation"),
    )


def dq_daily_report(assessment: DataFrame, outliers: DataFrame, ds: str) -> DataFrame:
    today = assessment.filter(F.col("ds") == ds)
    bad = F.col("status") != "PASS"
    crit = (F.col("severity") == "CRITICAL") & (F.col("status") == "FAIL")
    # the worst FAIL; lowest rule id on a tie
    worst = F.min(F.when(F.col("status") == "FAIL", F.struct(
        (-F.col("failure_rate")).alias("r"), "rule_id", "table_name", "error_details")))
    summary = today.agg(
        F.countDistinct("table_name").alias("total_tables_checked"), F.count("*").alias("total_rules_executed"),
        count_if(~bad).alias("passed"), count_if(crit).alias("critical_issues"),
        count_if((F.col("severity") == "WARNING") & bad).alias("warning_issues"), worst.alias("w"),
        F.sum("total_records").alias("records_processed"),
    ).withColumn("outliers_detected", outliers.agg(F.count("*")).scalar())
    advice = label(
        [(F.col("critical_issues") > 0, "Address critical data quality issues immediately"),
         (F.col("warning_issues") > 5, "Review warning issues and update cleansing rules"),
         (F.col("outliers_detected") > 10, "Investigate unusual data patterns")],
        "Data quality is within acceptable thresholds")
    return summary.select(
        F.lit(ds).alias("report_date"),
        F.round(F.try_divide(dbl("passed") * 100.0, dbl("total_rules_executed")), 2).alias("overall_quality_score"),
        "total_tables_checked", "total_rules_executed", "critical_issues", "warning_issues",
        F.coalesce("w.table_name", F.lit("None")).alias("top_issue_table"),
        F.coalesce("w.error_details", F.lit("No critical issues found")).alias("top_issue_description"),
        "outliers_detected", "records_processed", advice.alias("recommendations"),
    )
