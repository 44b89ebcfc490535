"""Declared schemas of the raw files and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def struct(spec: str) -> T.StructType:
    """``name type [not null], ...`` as a schema; unlike a DDL string it needs no session."""
    fields = []
    for column in spec.split(","):
        name, kind, *rest = column.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)


CSV_FEATURES = struct(
    """Customer_ID string, loyalty_member string, account_age_months int, total_orders int,
    days_since_last_purchase int, avg_order_value double, price_sensitivity_index double,
    browsing_frequency_per_week double, cart_abandonment_rate double, discount_usage_rate double,
    return_rate double, customer_support_tickets int, product_review_score_avg double,
    engagement_score double, satisfaction_score double"""
)
CSV_TARGETS = struct("Customer_ID string, churned string")
CSV_ORDERS = struct(
    """order_id int, order_date string, product_category string, payment_method string,
    order_status string, customer_age int, order_value double, delivery_time_days int,
    customer_rating double, discount_applied string"""
)

DIM_LOYALTY = struct("loyalty_status_id int not null, status_name string not null, description string")
DIM_DATE = struct(
    """date_id int not null, full_date date not null, year int not null, quarter int not null,
    month int not null, month_name string not null, week_of_year int not null,
    day_of_month int not null, day_of_week int not null, day_name string not null,
    is_weekend int not null"""
)
FACT_CUSTOMERS = struct(
    """customer_id string not null, loyalty_status_id int not null, account_age_months int not null,
    total_orders int not null, days_since_last_purchase int not null, avg_order_value double not null,
    price_sensitivity_index double not null, browsing_frequency_per_week double not null,
    cart_abandonment_rate double not null, discount_usage_rate double not null,
    return_rate double not null, customer_support_tickets int not null,
    product_review_score_avg double not null, engagement_score double not null,
    satisfaction_score double not null, churned int not null"""
)
FACT_ORDERS = struct(
    """order_id bigint not null, date_id int not null, product_category_id int not null,
    payment_method_id int not null, order_status_id int not null, customer_age int not null,
    order_value double not null, delivery_time_days int not null, customer_rating double not null,
    discount_applied int not null"""
)
CUSTOMER_SEGMENTS = struct(
    "customer_id string not null, cluster_id int not null, segment_name string not null"
)
CHURN_SCORES = struct(
    """customer_id string not null, churn_score double not null, churn_predicted int not null,
    risk_tier string not null"""
)


def lookup_schema(key: str, name: str) -> T.StructType:
    return struct(f"{key} int not null, {name} string not null")


WAREHOUSE = {
    "dim_loyalty_status": DIM_LOYALTY,
    "dim_product_category": lookup_schema("product_category_id", "category_name"),
    "dim_payment_method": lookup_schema("payment_method_id", "method_name"),
    "dim_order_status": lookup_schema("order_status_id", "status_name"),
    "dim_date": DIM_DATE,
    "fact_customers": FACT_CUSTOMERS,
    "fact_orders": FACT_ORDERS,
    "customer_segments": CUSTOMER_SEGMENTS,
    "churn_scores": CHURN_SCORES,
}

# Declared rules, checked by operators.quality (Spark does not enforce them on Parquet).
UNIQUE_KEYS = {
    "dim_loyalty_status": [["loyalty_status_id"], ["status_name"]],
    "dim_product_category": [["product_category_id"], ["category_name"]],
    "dim_payment_method": [["payment_method_id"], ["method_name"]],
    "dim_order_status": [["order_status_id"], ["status_name"]],
    "dim_date": [["date_id"], ["full_date"]],
    "fact_customers": [["customer_id"]],
    "fact_orders": [["order_id"]],
}
FOREIGN_KEYS = [
    ("fact_customers", "loyalty_status_id", "dim_loyalty_status", "loyalty_status_id"),
    ("fact_orders", "date_id", "dim_date", "date_id"),
    ("fact_orders", "product_category_id", "dim_product_category", "product_category_id"),
    ("fact_orders", "payment_method_id", "dim_payment_method", "payment_method_id"),
    ("fact_orders", "order_status_id", "dim_order_status", "order_status_id"),
]
DOMAIN_RULES = {
    "fact_customers": {"churned_flag": "churned IN (0, 1)"},
    "fact_orders": {"discount_flag": "discount_applied IN (0, 1)"},
    "dim_date": {
        "quarter_range": "quarter BETWEEN 1 AND 4",
        "month_range": "month BETWEEN 1 AND 12",
        "weekend_flag": "is_weekend IN (0, 1)",
    },
}
