"""Checks for joins, layered ETL, validation, pipeline and features."""

from __future__ import annotations

from stallkeeper.sources.adapters import AS_OF, BIZDATE, WEB_DATE, ctes

from .quality import assessment

_EMAIL = r"'^[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"


def _analytics() -> dict[str, str]:
    co = ctes("prospects", "shop_orders")
    spend = co + """, m as (select customer_id, first_name, last_name, n, s, k, last_order from prospects left join
        (select customer_id, count(*) n, sum(total_amount) s, count(total_amount) k, max(order_date) last_order from shop_orders group by 1) t using (customer_id)) """
    o = ctes("shop_orders")
    facts = ctes("catalog", "shop_order_items", "shop_orders") + """, f as (select i.product_id, sum(quantity)::bigint q, sum(line_total) r,
        sum(unit_price)::double/count(*) ap, count(distinct o.order_id) oc, count(distinct o.customer_id) uc
        from shop_order_items i left join shop_orders o on i.order_id=o.order_id group by 1) """
    return {
        "orders_with_customer": ctes("shop_customers", "shop_orders") + f"""select order_id, order_date, total_amount::double total_amount,
            first_name, last_name, country from shop_orders o join shop_customers c using (customer_id) where o.ds>='{BIZDATE}'""",
        "customer_order_summary": spend + """select customer_id, first_name, last_name, coalesce(n,0) total_orders,
            coalesce(s::double,0) total_spent, coalesce(s::double/k,0) avg_order_value from m""",
        "order_line_detail": ctes("shop_customers", "shop_orders", "shop_order_items", "shop_products") + f"""
            select o.order_id, o.order_date, c.first_name||' '||c.last_name customer_name, p.product_name, p.category, i.quantity,
            i.unit_price::double unit_price, i.line_total::double line_total
            from shop_order_items i, shop_orders o, shop_customers c, shop_products p
            where i.order_id=o.order_id and o.customer_id=c.customer_id and i.product_id=p.product_id and o.ds>='{BIZDATE}'""",
        "customer_spend_ranks": spend + """, t as (select customer_id, first_name, last_name, coalesce(s,0) v from m)
            select customer_id, first_name, last_name, v::double total_spent, row_number() over (order by v desc, customer_id) spending_rank,
            rank() over (order by v desc) spending_rank_with_ties, dense_rank() over (order by v desc) dense_spending_rank,
            ntile(4) over (order by v desc, customer_id)::int spending_quartile from t""",
        "running_and_moving": o + f"""select order_id, order_date, total_amount::double total_amount,
            (sum(total_amount) over (w rows unbounded preceding))::double running_total,
            (sum(total_amount) over (w rows 2 preceding))::double/(count(*) over (w rows 2 preceding)) moving_avg_3_orders,
            (lag(total_amount) over w)::double prev_order_amount, (lead(total_amount) over w)::double next_order_amount
            from shop_orders where ds>='{BIZDATE}' window w as (order by order_date, order_id)""",
        "product_sales_report": facts + """select product_id, product_name, category, oc orders_containing_product, q total_quantity_sold,
            r::double total_revenue, ap avg_selling_price, cost::double as cost, (r-q*cost)::double total_profit
            from catalog join f using (product_id) where q>0""",
        "customer_segment_rules": spend + f""", t as (select *, (date '{AS_OF}' - last_order::date)::int d from m)
            select customer_id, first_name, last_name, coalesce(n,0) total_orders, s::double total_spent, s::double/k avg_order_value,
            d days_since_last_order, case when s>200 and n>2 then 'VIP' when s>100 and n>1 then 'Regular' when n=1 then 'New' else 'Inactive' end customer_segment,
            case when d is null then 'Never Ordered' when d<=30 then 'Active' when d<=90 then 'At Risk' else 'Churned' end activity_status from t""",
        "monthly_trends": o + """select strftime(order_date,'%Y-%m') order_month, count(distinct order_id) total_orders,
            count(distinct customer_id) unique_customers, sum(total_amount)::double total_revenue, sum(total_amount)::double/count(*) avg_order_value,
            sum(total_amount)::double/count(distinct customer_id) revenue_per_customer from shop_orders where ds>='19960101' group by 1""",
        "same_city_pairs": ctes("shop_customers") + """, r as (select customer_id, first_name||' '||last_name name, city, country,
            lead(customer_id) over w nid, lead(first_name||' '||last_name) over w nname, count(*) over (w rows between 1 following and unbounded following) later
            from shop_customers window w as (partition by country, city order by customer_id))
            select customer_id customer1_id, name customer1_name, nid customer2_id, nname customer2_name, city, country, later later_partners
            from r where nid is not null""",
        "price_band_crosstab": ctes("shop_products") + """select category, count(*) filter (where price<50) under_50,
            count(*) filter (where price>=50 and price<100) from_50_to_100, count(*) filter (where price>=100 and price<200) from_100_to_200,
            count(*) filter (where price>=200) over_200, count(*) total_products from shop_products group by 1""",
        "product_performance": facts + """, t as (select p.product_id, product_name, category, coalesce(q,0) q, coalesce(r,0) r, coalesce(r-q*cost,0) g,
            coalesce(oc,0) oc, coalesce(uc,0) uc, coalesce(ap,0) ap from catalog p left join f using (product_id)),
            u as (select *, row_number() over (order by r desc, product_id) k from t)
            select product_id, product_name, category, q total_quantity_sold, r::double total_revenue, g::double total_profit,
            case when r>0 then g::double/r::double*1e2 else 0.0::double end profit_margin_pct, oc orders_count, uc unique_customers,
            ap avg_selling_price, k performance_rank, case when k<=5 then 'Top Performer' when k<=20 then 'Good Performer'
            when k<=50 then 'Average Performer' when r>0 then 'Under Performer' else 'No Sales' end performance_tier from u""",
        "underperforming_products": facts + """, t as (select *, (r-q*cost)::double*1e2/nullif(r::double,0) m from catalog left join f using (product_id))
            select product_id, product_name, category, coalesce(r::double,0) total_revenue, round(m,4) profit_margin_pct,
            case when r is null then 'NO_SALES' when m<45 then 'LOW_MARGIN' when r::double<50 then 'LOW_REVENUE' else 'OK' end flag from t""",
    }


def _sales() -> dict[str, str]:
    base = ctes("shop_orders", "shop_order_items", "shop_products") + f""",
        rev as (select product_id, category, sum(line_total) r from shop_order_items join shop_orders using (order_id)
          join shop_products using (product_id) where ds='{BIZDATE}' group by 1,2),
        cat as (select category, sum(r) r from rev group by 1 order by 2 desc, 1 limit 1),
        prod as (select product_id, r from rev order by r desc, product_id limit 1) """
    daily = f"""select strftime(order_date,'%Y-%m-%d') sales_date, count(distinct order_id) total_orders, sum(total_amount)::double total_revenue,
        count(distinct customer_id) total_customers, sum(total_amount)::double/count(*) avg_order_value,
        (select category from cat) top_category, (select product_id from prod) top_product_id
        from shop_orders where ds='{BIZDATE}' and order_status='completed' group by 1"""
    rfm = ctes("prospects", "shop_orders") + f""", m as (select c.customer_id, count(o.order_id) n, coalesce(sum(total_amount),0) s,
        coalesce(sum(total_amount)::double/count(total_amount),0) a,
        (date '{AS_OF}' - coalesce(max(order_date)::date, any_value(registration_date)))::int d
        from prospects c left join shop_orders o on c.customer_id=o.customer_id group by 1),
        sc as (select *, case when d<=30 then 5 when d<=60 then 4 when d<=90 then 3 when d<=180 then 2 else 1 end r,
        case when n>=10 then 5 when n>=5 then 4 when n>=3 then 3 when n>=2 then 2 else 1 end f,
        case when s>=1000 then 5 when s>=500 then 4 when s>=200 then 3 when s>=100 then 2 else 1 end v from m) """
    return {
        "daily_sales_summary": base + daily,
        "top_category": base + "select category top_category, r::double category_revenue from cat",
        "top_product": base + "select product_id top_product_id, r::double product_revenue from prod",
        "rfm_scores": rfm + """select customer_id, n total_orders, s::double total_spent, a avg_order_value, d days_since_last_order,
            r recency_score, f frequency_score, v monetary_score from sc""",
        "rfm_segments": rfm + """select customer_id, 'RFM' segment_type, case when r+f+v>=12 then 'Champions' when r+f+v>=10 then 'Loyal Customers'
            when r+f+v>=8 then 'Potential Loyalists' when r+f+v>=6 then 'At Risk' when r+f+v>=4 then 'Cannot Lose' else 'Lost Customers' end segment_value,
            n total_orders, s::double total_spent, a avg_order_value, d days_since_last_order, (r+f+v)::double/3 segment_score from sc""",
        "value_segments": ctes("prospects", "shop_orders") + f"""select c.customer_id, 'value_segment' segment_type,
            case when sum(total_amount)>=1000 then 'High Value' when sum(total_amount)>=500 then 'Mid Value' else 'Low Value' end segment_value,
            count(distinct o.order_id) total_orders, coalesce(sum(total_amount)::double,0) total_spent,
            coalesce(sum(total_amount)::double/count(total_amount),0) avg_order_value, (date '{AS_OF}' - max(order_date)::date)::int days_since_last_order,
            coalesce(sum(total_amount)::double,0)/1e2 segment_score
            from prospects c left join shop_orders o on c.customer_id=o.customer_id group by 1""",
        "etl_job_status_log": base + f", d as ({daily}) select 'daily_sales_summary' job_name, 'FACT_TABLE' job_type, "
            "timestamp '1996-09-02 02:00:00' start_time, timestamp '1996-09-02 02:12:00' end_time, 'SUCCESS' status, "
            f"null::varchar error_message, count(*) records_processed, '{BIZDATE}' ds from d",
    }


def _web() -> dict[str, str]:
    base = ctes("shop_web_sessions", "shop_page_views", "shop_purchases") + f""",
        ses as (select * from shop_web_sessions where ds='{WEB_DATE}'),
        src as (select traffic_source, count(*) source_count from ses group by 1 order by 2 desc, 1 limit 1),
        pages as (select page_url, count(distinct session_id) sessions_with_views, count(*) total_views,
          row_number() over (order by count(*) desc, page_url) page_rank from shop_page_views where ds='{WEB_DATE}' group by 1) """
    day = "exists (select 1 from shop_purchases p where p.order_date::date=s.session_start::date)"
    user = "exists (select 1 from shop_purchases p where p.order_date::date=s.session_start::date and p.user_id=s.user_id)"
    conv = "select count(*) total_sessions_count, count(*) filter (where {0}) converted_sessions from ses s"
    summary = "select '" + WEB_DATE + """' analysis_date, count(*) total_sessions, count(distinct user_id) unique_users, sum(page_views)::bigint total_page_views,
        sum(session_duration_seconds)::double/count(*) avg_session_duration, count(*) filter (where page_views=1)*1e2/count(*) bounce_rate,
        count(*) filter (where {0})*1e2/count(*) conversion_rate, (select traffic_source from src) top_traffic_source,
        (select page_url from pages where page_rank=1) top_page, count(*) filter (where device_type='mobile')*1e2/count(*) mobile_percentage
        from ses s having count(*)>0"""
    return {
        "web_analytics_summary": base + summary.format(day), "web_analytics_summary_by_user": base + summary.format(user),
        "top_traffic_source": base + "select * from src", "page_rank_by_views": base + "select * from pages",
        "session_conversion": base + conv.format(day), "session_conversion_by_user": base + conv.format(user),
    }


def _changes() -> dict[str, str]:
    base = ctes("shop_customers", "shop_customers_prev") + """, j as (select coalesce(c.customer_id,p.customer_id) customer_id,
        case when p.customer_id is null then 'INSERT' when c.customer_id is null then 'DELETE' else 'UPDATE' end change_type,
        c.customer_id ci, c.first_name cf, c.last_name cl, c.email ce, p.customer_id pi, p.first_name pf, p.last_name pl, p.email pe
        from shop_customers c full join shop_customers_prev p on c.customer_id=p.customer_id
        where p.customer_id is null or c.customer_id is null or c.first_name<>p.first_name or c.last_name<>p.last_name or c.email<>p.email) """
    v1 = """'{{"first_name":"'||{0}f||'","last_name":"'||{0}l||'","email":"'||{0}e||'"}}'"""
    v2 = """'{{"first_name":"'||coalesce({0}f,'')||'","email":"'||coalesce({0}e,'')||'"}}'"""

    def pick(body: str) -> str:
        return base + (f"select customer_id, change_type, case when pi is not null then {body.format('p')} end old_data, "
                       f"case when ci is not null then {body.format('c')} end new_data, false as processed from j")

    return {
        "snapshot_change_detect": pick(v1), "snapshot_tree_diff": pick(v1), "snapshot_change_detect_v2": pick(v2),
        "snapshot_self_diff": ctes("shop_customers") + """select customer_id, ''::varchar change_type, ''::varchar old_data, ''::varchar new_data,
            false as processed from shop_customers where customer_id<>customer_id""",
        "snapshot_change_null_safe": ctes("shop_customers") + """select customer_id, 'UPDATE' change_type from shop_customers where customer_id%37=0""",
    }


def _validation() -> dict[str, str]:
    clean = ctes("shop_customers", "shop_products", "shop_orders", "shop_order_items")
    dirty = ctes("dirty_customers", "dirty_orders", "dirty_products", "shop_products", "shop_customers")
    prod = ctes("shop_products")
    items = ctes("loose_items", "shop_orders", "shop_products")
    return {
        "tables_nonempty": clean + """select 'Table Existence Check' test_name, if(exists(from shop_customers),'PASS','FAIL') customers_test,
            if(exists(from shop_products),'PASS','FAIL') products_test, if(exists(from shop_orders),'PASS','FAIL') orders_test""",
        "count_validation": clean + """select 'Data Count Validation' test_name, (select count(*) from shop_customers) customer_count,
            (select count(*) from shop_products) product_count, (select count(*) from shop_orders) order_count, (select count(*) from shop_order_items) order_items_count""",
        "null_key_check": clean + """select 'NULL Value Check' test_name, (select count(*)-count(customer_id) from shop_customers) null_customer_ids,
            (select count(*)-count(product_id) from shop_products) null_product_ids, (select count(*)-count(order_id) from shop_orders) null_order_ids""",
        "email_validation": dirty + f"""select 'Email Validation' test_name, count(*) total_customers, count(*) filter (where regexp_matches(email,{_EMAIL})) valid_emails,
            count(*)-count(*) filter (where regexp_matches(email,{_EMAIL})) invalid_emails from dirty_customers""",
        "price_validation": dirty + """select 'Price Validation' test_name, count(*) total_products, count(*) filter (where cost>0 and price>cost) valid_pricing,
            count(*) filter (where least(price,cost)<=0 or price<=cost) invalid_pricing from dirty_products""",
        "amount_validation": dirty + """select 'Order Amount Validation' test_name, count(*) total_orders, count(*) filter (where total_amount>0) positive_amounts,
            count(*) filter (where total_amount<=0) non_positive_amounts, min(total_amount)::double min_amount, max(total_amount)::double max_amount,
            sum(total_amount)::double/count(*) avg_amount from dirty_orders""",
        "orphan_orders": dirty + """select 'Orphaned Orders Check' test_name, count(*) total_orders, count(c.customer_id) orders_with_valid_customers,
            count(*) filter (where c.customer_id is null) orphaned_orders from dirty_orders o left join shop_customers c on c.customer_id=o.customer_id""",
        "orphan_order_items": items + """select 'Orphaned Order Items Check' test_name, count(*) total_order_items, count(o.order_id) items_with_valid_orders,
            count(p.product_id) items_with_valid_products, count(*)-count(o.order_id) items_missing_orders, count(*)-count(p.product_id) items_missing_products
            from loose_items i left join shop_orders o on o.order_id=i.order_id
            left join shop_products p on p.product_id=i.product_id""",
        "orphan_order_items_v2": items + """select 'Orphaned Order Items Check' test_name, count(*) total_order_items, count(o.order_id) items_with_valid_orders,
            count(*)-count(o.order_id) orphaned_items from loose_items i left join shop_orders o on o.order_id=i.order_id""",
        "order_total_verification": clean + """, g as (select abs(total_amount-coalesce((select sum(line_total) from shop_order_items i where i.order_id=o.order_id),0)) d from shop_orders o)
            select 'Order Total Verification' test_name, count(*) total_orders, count(*) filter (where d<0.01) matching_totals,
            count(*) filter (where d>=0.01) mismatched_totals, max(d)::double max_difference from g""",
        "date_range_validation": clean + """select 'Date Range Validation' test_name, min(registration_date)::varchar earliest_registration,
            max(registration_date)::varchar latest_registration, (select min(order_date)::date::varchar from shop_orders) earliest_order,
            (select max(order_date)::date::varchar from shop_orders) latest_order,
            if((select min(order_date) from shop_orders)>=min(registration_date),'PASS','FAIL') date_logic_check from shop_customers""",
        "partition_prune_count": clean + f"""select 'Partition Pruning Test' test_name, count(*) records_in_partition,
            'Should execute quickly with partition pruning' note from shop_orders where ds='{BIZDATE}'""",
        "in_list_distinct": clean + """select 'Customer Lookup Test' test_name, count(distinct customer_id) unique_customers,
            'Should execute quickly with proper indexing' note from shop_orders where customer_id between 1 and 3""",
        "aggregation_consistency": clean + """, h as (select count(distinct customer_id) c, count(distinct order_id) o, sum(total_amount) s from shop_orders),
            d as (select count(distinct customer_id) c, count(distinct order_id) o, sum(line_total) s from shop_order_items join shop_orders using (order_id))
            select 'Aggregation Consistency' test_name, h.c unique_customers, d.c unique_customers_detailed, h.o unique_orders, d.o unique_orders_detailed,
            round(h.s,2)::double order_total_revenue, round(d.s,2)::double item_total_revenue,
            if(abs(h.s-d.s)<1,'PASS','FAIL') revenue_consistency_check from h, d""",
        "distribution_pct": clean + """select 'Data Distribution Check' test_name, 'Customers by Country' metric, country, count(*) as count,
            round(count(*)*1e2/(select count(*) from shop_customers),2) percentage from shop_customers group by country""",
        "category_price_stats": prod + """select 'Product Category Distribution' test_name, category, count(*) product_count,
            round(sum(price)::double/count(*),2) avg_price, round(min(price),2)::double min_price, round(max(price),2)::double max_price from shop_products group by category""",
        "health_summary": dirty + f""", h as (select 'customers' table_name, count(*) n, count(customer_id) k, count(*) filter (where regexp_matches(email,{_EMAIL})) q from dirty_customers
            union all select 'products', count(*), count(product_id), count(*) filter (where price>0 and cost>0) from shop_products
            union all select 'orders', count(*), count(order_id), count(*) filter (where total_amount>0) from dirty_orders), p as (select *, k*1e2/n kp, q*1e2/n qp from h)
            select table_name, n total_records, k records_with_key, q quality_records, round(kp,2) key_completeness_pct, round(qp,2) data_quality_pct,
            case when kp>=95 and qp>=90 then 'EXCELLENT' when kp>=90 and qp>=80 then 'GOOD' when kp>=80 and qp>=70 then 'FAIR' else 'NEEDS_IMPROVEMENT' end overall_health from p""",
    }


def _features() -> dict[str, str]:
    co = ctes("shop_customers", "shop_orders")
    cutoff = "date '2001-03-01'"
    return {
        "top10_customers": co + """select customer_id, first_name, last_name, country, sum(total_amount)::double total_spent, count(*) total_orders
            from shop_orders join shop_customers using (customer_id) group by 1,2,3,4 order by sum(total_amount) desc, customer_id limit 10""",
        "aov_by_country": co + """select country, count(*) total_orders, sum(total_amount)::double/count(*) avg_order_value
            from shop_orders join shop_customers using (customer_id) group by 1""",
        "inactive_customers_30d": ctes("prospects", "shop_orders") + f"""select customer_id, first_name, last_name, country from prospects
            where customer_id not in (select customer_id from shop_orders where order_date::date >= date '{AS_OF}' - 30)""",
        "top_products_per_category": ctes("shop_products", "shop_order_items") + """, r as (select category, product_id, product_name, sum(line_total) v
            from shop_order_items join shop_products using (product_id) group by 1,2,3)
            select category, row_number() over (partition by category order by v desc, product_id) category_rank, product_id, product_name,
            v::double total_revenue from r qualify category_rank<=3""",
        "customer_features": ctes("prospects", "shop_orders", "shop_order_items") + f""",
            sz as (select order_id, sum(quantity) u, sum(discount_amount) dsc, sum(line_total) ln from shop_order_items group by 1),
            m as (select customer_id, count(*) n, sum(total_amount) s, max(total_amount) mx, min(order_date)::date fo, max(order_date)::date lo, sum(u) u,
              sum(dsc) dsc, sum(ln) ln, count(*) filter (where order_status='completed') dn, count(*) filter (where extract(dow from order_date) in (0,6)) we
              from shop_orders left join sz using (order_id) where order_date::date<=date '{AS_OF}' group by 1)
            select customer_id, (date '{AS_OF}'-registration_date)::int tenure_days, coalesce(n,0) order_count, coalesce(s::double,0) total_spent,
            s::double/n avg_order_value, mx::double max_order_value, (date '{AS_OF}'-lo)::int recency_days, (lo-fo)::double/nullif(n-1,0) avg_gap_days,
            coalesce(u,0)::bigint units_bought, dn*1e2/n completed_pct, we*1e2/n weekend_pct, dsc::double/nullif((dsc+ln)::double,0) discount_share
            from prospects left join m using (customer_id)""",
        "copurchase_features": ctes("shop_order_items") + """, l as (select distinct order_id, product_id from shop_order_items),
            sold as (select product_id, count(*) n from l group by 1), nb as (select count(distinct order_id) b from l),
            t as (select x.product_id anchor_id, y.product_id partner_id, count(*) k from l x join l y on x.order_id=y.order_id and x.product_id<>y.product_id
              group by 1,2 having count(*)>=2)
            select anchor_id, partner_id, k together, k::double/b support, k::double/a.n confidence, (k*b)::double/(a.n*p.n)::double lift
            from t join sold a on a.product_id=anchor_id join sold p on p.product_id=partner_id, nb""",
        "churn_dataset": co + f""", b as (select customer_id, count(*) n, sum(total_amount) s, max(order_date)::date ld,
              count(*) filter (where order_date::date > {cutoff} - 180) n180 from shop_orders where order_date::date<={cutoff} group by 1),
            a as (select distinct customer_id k from shop_orders where order_date::date>{cutoff} and order_date::date<={cutoff}+90)
            select customer_id, country, n order_count, s::double total_spent, s::double/n avg_order_value, ({cutoff}-ld)::int recency_days,
            n180 orders_180d, if(k is null,1,0)::int churned from b join shop_customers using (customer_id) left join a on k=customer_id""",
        "job_sla_report": ctes("shop_orders") + """, j as (select order_id, 3000+order_id%7001 d, order_id%50=0 f from shop_orders)
            select 'load_'||order_id job_name, if(f,'FAILED','SUCCESS') status, d duration_seconds,
            case when f then 'FAILED' when d>9000 then 'CRITICAL' when d>5400 then 'WARNING' else 'OK' end sla_level,
            case when f then 'ETL workflow has failed nodes' when d>5400 then 'ETL workflow is taking longer than expected' end alert_message from j""",
    }


def oracles() -> dict[str, str]:
    return {**_analytics(), **_sales(), **_web(), **_changes(), **_validation(), **_features()}
