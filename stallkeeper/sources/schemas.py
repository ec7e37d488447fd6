"""Declared table schemas of the three layers.

Fixed values: table and column names of the shop warehouse.  Raw (ods) date
columns stay text until ``typed_view`` casts them.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_PEOPLE = ("customer_id string, first_name string, last_name string, email string, phone string, "
           "registration_date string, country string, city string, age_group string")

ODS = {
    "customers": _PEOPLE,
    "products": "product_id string, product_name string, category string, sub_category string, brand string, "
                "price double, cost double, supplier_id string, launch_date string",
    "orders": "order_id string, customer_id string, order_date string, order_status string, total_amount double, "
              "shipping_cost double, payment_method string, shipping_address string, ds string",
    "order_items": "order_item_id string, order_id string, product_id string, quantity bigint, unit_price double, "
                   "discount_amount double, line_total double, ds string",
    "web_sessions": "session_id string, user_id string, session_start string, session_end string, page_views bigint, "
                    "session_duration_seconds bigint, traffic_source string, device_type string, browser string, "
                    "country string, ds string",
    "page_views": "page_view_id string, session_id string, user_id string, page_url string, page_title string, "
                  "timestamp string, time_on_page_seconds bigint, referrer_url string, exit_page string, ds string",
    "user_events": "event_id string, session_id string, user_id string, event_type string, event_timestamp string, "
                   "page_url string, element_id string, element_type string, event_data string, ds string",
    "suppliers": "supplier_id string, supplier_name string, contact_name string, email string, phone string, "
                 "country string, city string, product_category string, rating double",
    "customers_snapshot": _PEOPLE + ", ds string",
}

DWD = {
    "daily_sales_summary": "sales_date string, total_orders bigint, total_revenue double, total_customers bigint, "
                           "avg_order_value double, top_category string, top_product_id string, ds string",
    "customer_segments": "customer_id string, segment_type string, segment_value string, total_orders bigint, "
                         "total_spent double, avg_order_value double, days_since_last_order bigint, "
                         "segment_score double, updated_date timestamp, ds string",
    "product_performance": "product_id string, product_name string, category string, total_quantity_sold bigint, "
                           "total_revenue double, total_profit double, profit_margin_pct double, orders_count bigint, "
                           "unique_customers bigint, avg_selling_price double, performance_rank bigint, "
                           "performance_tier string, analysis_date timestamp, ds string",
}

ADS = {
    "web_analytics_summary": "analysis_date string, total_sessions bigint, unique_users bigint, "
                             "total_page_views bigint, avg_session_duration double, bounce_rate double, "
                             "conversion_rate double, top_traffic_source string, top_page string, "
                             "mobile_percentage double, ds string",
    "customer_changes": "customer_id string, change_type string, old_data string, new_data string, "
                        "change_timestamp timestamp, processed boolean, ds string",
    "data_quality_metrics": "table_name string, metric_name string, metric_value double, threshold_value double, "
                            "status string, check_timestamp timestamp, ds string",
    "dq_rules": "rule_id string, table_name string, column_name string, rule_type string, rule_definition string, "
                "threshold_value double, severity string, active boolean, created_date timestamp",
    "data_profile": "table_name string, column_name string, data_type string, total_records bigint, "
                    "null_count bigint, null_percentage double, distinct_count bigint, min_value string, "
                    "max_value string, avg_value double, std_dev double, profile_date timestamp, ds string",
    "dq_assessment": "rule_id string, table_name string, column_name string, rule_type string, "
                     "total_records bigint, failed_records bigint, failure_rate double, threshold_value double, "
                     "status string, severity string, error_details string, assessment_date timestamp, ds string",
    "customers_clean": "customer_id string, first_name string, last_name string, email string, email_clean string, "
                       "phone string, phone_clean string, registration_date timestamp, country string, "
                       "country_clean string, city string, city_clean string, age_group string, "
                       "cleansing_flags string, cleansed_date timestamp",
    "data_outliers": "table_name string, column_name string, record_id string, value_found string, "
                     "outlier_type string, z_score double, percentile_rank double, expected_range string, "
                     "detection_method string, severity string, detected_date timestamp, ds string",
    "dq_daily_report": "report_date string, overall_quality_score double, total_tables_checked bigint, "
                       "total_rules_executed bigint, critical_issues bigint, warning_issues bigint, "
                       "top_issue_table string, top_issue_description string, outliers_detected bigint, "
                       "records_processed bigint, recommendations string, ds string",
    "etl_job_status": "job_name string, job_type string, start_time timestamp, end_time timestamp, status string, "
                      "records_processed bigint, error_message string, ds string",
}

LAYERS = {"ods": ODS, "dwd": DWD, "ads": ADS}

# Days each partitioned table is kept.
RETENTION_DAYS = {
    "customers": 365, "products": 365, "orders": 365, "order_items": 365, "web_sessions": 90,
    "daily_sales_summary": 365, "customer_segments": 365, "product_performance": 365, "web_analytics_summary": 90,
    "customer_changes": 30, "data_quality_metrics": 90, "etl_job_status": 30, "data_profile": 90,
    "dq_assessment": 90, "data_outliers": 90, "dq_daily_report": 365,
}


def schema_of(layer: str, table: str) -> StructType:
    return StructType.fromDDL(LAYERS[layer][table])
