"""What the checks of the whole build compare."""

#: For each model of the build its query, key columns and a measure.
CONTENT = {
    "stg_payment_events": ("m01_stg_payment_events", ["event_id"], "amount_cents"),
    "int_payment_customer_metrics": ("m02_customer_metrics", ["customer_id"], "total_revenue_cents"),
    "int_payment_merchant_metrics": ("m03_merchant_metrics", ["merchant_id"], "total_revenue_cents"),
    "int_payment_daily_summary": ("m04_daily_summary", ["event_date"], "total_revenue_cents"),
    "dim_customer": ("m05_dim_customer", ["customer_id", "customer_tier"], "total_revenue_cents"),
    "dim_merchant": ("m06_dim_merchant", ["merchant_id", "health_category"], "health_score"),
    "dim_date": ("m07_dim_date", ["date_key"], "day_of_year"),
    "fct_payments": ("m08_fct_payments", ["payment_key", "status_category"], "amount_cents"),
    "fct_daily_payments": ("m09_fct_daily_payments", ["date_key"], "total_revenue_cents"),
    "feat_customer_features": ("x01_feat_customer", ["customer_id"], "total_amount_cents_30d"),
    "feat_merchant_features": ("x02_feat_merchant", ["merchant_id"], "unique_customers_30d"),
    "analytics_payment_intervals": ("a01_payment_intervals", ["interval_start"], "transaction_count"),
    "analytics_payment_summary": ("a02_payment_summary", ["interval_start"], "total_transactions"),
    "analytics_provider_comparison": ("a03_provider_comparison", ["interval_start", "provider"], "total_transactions"),
    "analytics_risk_overview": ("a04_risk_overview", ["interval_start"], "total_transactions"),
    "analytics_payment_trends": ("a05_payment_trends", ["date_key"], "revenue_cents"),
    "analytics_customer_segments": ("a06_customer_segments", ["segment_type", "segment_value"], "segment_revenue_cents"),
}
LATER = "2024-07-01 00:00:00"
