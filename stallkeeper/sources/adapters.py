"""Shop tables derived from the benchmark parquet tables.

The view texts use only SQL that Spark and DuckDB share, so the same text
feeds a job and its check.  ``Shop`` renders them over parquet paths.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

BIZDATE = "19960901"
WEB_DATE = "20240115"
AS_OF = "2001-08-02"

_YMD = "cast(year({0})*10000+month({0})*100+{1} as string)"

VIEWS: dict[str, str] = {
    "shop_customers": """
select c_custkey customer_id, split_part(c_name,'#',1) first_name, split_part(c_name,'#',2) last_name,
 lower(split_part(c_name,'#',1))||'.'||split_part(c_name,'#',2)||'@'||lower(c_mktsegment)||'.example.com' email,
 '+1-555-'||lpad(cast(c_custkey%10000 as string),4,'0') phone,
 date '1994-01-01' + cast(c_custkey%365 as int) registration_date,
 n_name country, n_name||'_'||cast(c_custkey%20 as string) city,
 case c_custkey%4 when 0 then '18-24' when 1 then '25-34' when 2 then '35-44' else '45-54' end age_group
from {customer} join {nation} on c_nationkey=n_nationkey""",
    "shop_products": """
select p_partkey product_id, p_name product_name, p_type category, p_brand brand,
 cast(cast(p_retailprice as decimal(10,2))*cast(1+p_partkey%9 as decimal(4,0))*0.025 as decimal(18,6)) price,
 cast(cast(p_retailprice as decimal(10,2))*cast(1+p_partkey%9 as decimal(4,0))*0.025
   *cast(4+p_size%5 as decimal(4,0))*0.1 as decimal(18,6)) cost,
 p_partkey%100 supplier_id, date '1994-01-01' + cast(p_partkey%700 as int) launch_date
from {part}""",
    "shop_orders": f"""
select o_orderkey order_id, o_custkey customer_id, o_orderdate order_date,
 case o_orderstatus when 'F' then 'completed' when 'O' then 'shipped' else 'processing' end order_status,
 cast(cast(o_totalprice as decimal(12,2))*0.0002 as decimal(18,6)) total_amount,
 o_orderpriority payment_method, {_YMD.format('o_orderdate', '1')} ds
from {{orders}}""",
    "shop_order_items": """
select l_orderkey order_id, l_partkey product_id, cast(1+l_linenumber%5 as bigint) quantity,
 cast(cast(l_extendedprice as decimal(12,2))*0.0002 as decimal(18,6)) unit_price,
 cast(cast(l_extendedprice as decimal(12,2))*0.0002*cast(l_discount as decimal(4,2)) as decimal(18,8)) discount_amount,
 cast(cast(l_extendedprice as decimal(12,2))*0.0002
   *(cast(1+l_linenumber%5 as decimal(4,0))-cast(l_discount as decimal(4,2))) as decimal(18,8)) line_total
from {lineitem}""",
    "shop_suppliers": """
select s_suppkey supplier_id, s_name supplier_name, n_name country,
 n_name||'_'||cast(s_suppkey%20 as string) city, cast(s_acctbal as decimal(12,2)) rating
from {supplier} join {nation} on s_nationkey=n_nationkey""",
    "shop_web_sessions": f"""
select cast(user_id as string)||'-'||cast(cast(ts as date) as string) session_id, user_id,
 min(ts) session_start, max(ts) session_end, count(*) page_views,
 cast(hour(max(ts))*3600+minute(max(ts))*60+second(max(ts))
   - (hour(min(ts))*3600+minute(min(ts))*60+second(min(ts))) as bigint) session_duration_seconds,
 min_by(event_type,ts) traffic_source,
 case user_id%3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end device_type,
 {_YMD.format('cast(ts as date)', 'day(cast(ts as date))')} ds
from {{events}} group by user_id, cast(ts as date)""",
    "shop_page_views": f"""
select event_id page_view_id, cast(user_id as string)||'-'||cast(cast(ts as date) as string) session_id, user_id,
 '/'||event_type||'/'||cast(event_id%20 as string) page_url, ts, {_YMD.format('ts', 'day(ts)')} ds
from {{events}} where event_type in ('view','click')""",
    "shop_purchases": """
select event_id order_id, user_id, ts order_date from {events} where event_type='purchase'""",
    "shop_customers_prev": """
select customer_id, case when customer_id%53=0 then first_name||'_old' else first_name end first_name, last_name, email
from {shop_customers} where customer_id%97<>0
union all
select customer_id+1000000000, first_name, last_name, email from {shop_customers} where customer_id%89=0""",
    "dirty_customers": """
select customer_id, first_name, last_name,
 case when customer_id%37=0 then null when customer_id%41=0 then 'not-an-email'
      when customer_id%43=0 then ' '||email when customer_id%47=0 then upper(email) else email end email,
 case when customer_id%31=0 then null else phone end phone, registration_date,
 case customer_id%7 when 0 then ' usa ' when 1 then 'United Kingdom' when 2 then 'CN' else country end country,
 case when customer_id%5=0 then city else lower(city) end city, age_group
from {shop_customers}
union all
select customer_id, first_name, last_name, email, phone, registration_date, country, city, age_group
from {shop_customers} where customer_id%101=0""",
    "dirty_orders": """
select order_id, case when order_id%173=0 then customer_id+1000000000 else customer_id end customer_id, order_date,
 case when order_id%211=0 then -total_amount when order_id%307=0 then total_amount*50 else total_amount end total_amount, ds
from {shop_orders}""",
    "dirty_products": """
select product_id, price, case when product_id%59=0 then price+1 else cost end cost from {shop_products}""",
    # customers without orders, products without sales, and items of unknown orders and products, for the empty branches
    "prospects": """
select * from {shop_customers}
union all
select customer_id+2000000000, first_name, last_name, email, phone, registration_date, country, city, age_group
from {shop_customers} where customer_id%11=0""",
    "catalog": """
select * from {shop_products}
union all
select product_id+2000000000, product_name, category, brand, price, cost, supplier_id, launch_date
from {shop_products} where product_id%13=0""",
    "loose_items": """
select order_id, product_id from {shop_order_items}
union all
select order_id+2000000000, product_id from {shop_order_items} where order_id%11=0
union all
select order_id, product_id+2000000000 from {shop_order_items} where product_id%13=0""",
    "shop_text": """
select doc_id, lang, source,
 case doc_id%8
  when 0 then text||' Good quality, great value, love it'
  when 1 then text||' terrible and broken, the worst'
  when 2 then text||' not good'
  when 3 then '<p>'||text||'</p> Fish &amp; chips, call 123-456-7890 or see http://example.com/a?b=1'
  when 5 then text||' write to jane.doe@example.com now'
  else text end text
from {documents}
union all
select doc_id+1000000000, lang, source, '这个产品非常好我很喜欢质量不错' from {documents} where doc_id%8=4""",
}

_HOLE = re.compile(r"\{(\w+)\}")


def _needs(name: str) -> list[str]:
    return [h for h in _HOLE.findall(VIEWS[name]) if h in VIEWS]


def spark_text(name: str, sf_dir: str, where: dict[str, str] | None = None) -> str:
    """View text with base tables as parquet paths, views inlined; ``where`` filters base tables at their scans."""

    def fill(match: re.Match) -> str:
        hole = match.group(1)
        if hole in VIEWS:
            return f"({spark_text(hole, sf_dir, where)})"
        path = f"parquet.`{sf_dir}/{hole}.parquet`"
        return f"(select * from {path} where {where[hole]})" if where and hole in where else path

    return _HOLE.sub(fill, VIEWS[name])


def ctes(*names: str) -> str:
    """``WITH`` clause defining the named views over pre-registered tables."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dep in _needs(name):
                visit(dep)
            ordered.append(name)

    for name in names:
        visit(name)
    body = ",\n".join(f"{n} as ({_HOLE.sub(lambda m: m.group(1), VIEWS[n])})" for n in ordered)
    return f"with {body}\n"


class Shop:
    """The shop tables of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.spark.sql(spark_text(name, self.sf_dir))
        if f"shop_{name}" in VIEWS:
            return self.spark.sql(spark_text(f"shop_{name}", self.sf_dir))
        raise AttributeError(name)

    def items_of(self, lines: DataFrame, *more: str) -> DataFrame:
        """The order items of ``lines`` with ``lineitem``'s columns, and ``more`` of their columns."""
        columns = VIEWS["shop_order_items"].rsplit("from {lineitem}", 1)[0]
        return self.spark.sql(f"{', '.join([columns.rstrip(), *more])} from {{lineitem}}", lineitem=lines)

    def orders_since(self, ds: str) -> DataFrame:
        """Load partitions from ``ds`` on, with the date bound pushed to the scan: a partition holds no day before its own."""
        return self.orders.filter((F.col("order_date") >= F.to_timestamp(F.lit(ds), "yyyyMMdd")) & (F.col("ds") >= ds))

    def on_day(self, view: str, ds: str) -> DataFrame:
        """A view over ``events`` of one day, with the day's bounds pushed to the scan."""
        day = f"{ds[:4]}-{ds[4:6]}-{ds[6:]}"
        bounds = f"ts >= timestamp_ntz'{day} 00:00:00' and ts < timestamp_ntz'{day} 00:00:00' + interval 1 day"
        return self.spark.sql(spark_text(view, self.sf_dir, {"events": bounds}))

    def month_of_orders(self, ds: str) -> DataFrame:
        """One load partition of orders, with its date range pushed to the scan."""
        first = F.to_timestamp(F.lit(ds), "yyyyMMdd")
        in_month = (F.col("order_date") >= first) & (F.col("order_date") < F.add_months(first, 1).cast("timestamp"))
        return self.orders.filter(in_month & (F.col("ds") == ds))
