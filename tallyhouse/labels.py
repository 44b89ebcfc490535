"""Codes used inside the library and the display values users see.

Joins and ordering always use codes; display names are attached last.
"""

from __future__ import annotations

# Segment code -> display name (two of the names carry two spaces).
SEGMENT_NAMES = {
    "high_value": "💎 Cliente Premium",
    "loyal": "🌟 Cliente Leal",
    "at_risk": "⚠️  Cliente en Riesgo",
    "price_hunter": "🏷️  Cazador de Ofertas",
}

# Risk tier code -> display name.
TIER_NAMES = {"low": "Bajo", "medium": "Medio", "high": "Alto", "critical": "Crítico"}

# Report orders.
SEGMENT_ORDER = ["high_value", "loyal", "price_hunter", "at_risk"]
TIER_ORDER = ["critical", "high", "medium", "low"]
WEEKDAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Right-closed bin edges and their labels.
TIER_EDGES = [0.0, 0.25, 0.50, 0.75, 1.01]
TIER_LABELS = ["low", "medium", "high", "critical"]
TENURE_EDGES = [0, 12, 24, 36, 60, 999]
TENURE_LABELS = ["0-12m", "13-24m", "25-36m", "37-60m", "60m+"]

# The two loyalty rows.
LOYALTY_ROWS = [("Yes", "Loyalty Member"), ("No", "Regular Customer")]

# Tokens the raw files may use for a missing value.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Names that mark a critical customer as recoverable or lost.
RECOVERABLE_PATTERN = "Leal|Ofertas|Premium"
LOST_PATTERN = "Riesgo"

# Feature lists.
SEGMENT_FEATURES = [
    "avg_order_value",
    "total_orders",
    "engagement_score",
    "browsing_frequency_per_week",
    "cart_abandonment_rate",
    "days_since_last_purchase",
    "return_rate",
    "customer_support_tickets",
    "satisfaction_score",
    "product_review_score_avg",
]
CHURN_FEATURES = [
    "account_age_months",
    "avg_order_value",
    "total_orders",
    "days_since_last_purchase",
    "price_sensitivity_index",
    "browsing_frequency_per_week",
    "cart_abandonment_rate",
    "return_rate",
    "customer_support_tickets",
    "product_review_score_avg",
    "engagement_score",
    "satisfaction_score",
    "loyalty_member",
]
CORRELATION_FEATURES = [
    "account_age_months",
    "avg_order_value",
    "total_orders",
    "days_since_last_purchase",
    "discount_usage_rate",
    "return_rate",
    "customer_support_tickets",
    "product_review_score_avg",
    "browsing_frequency_per_week",
    "cart_abandonment_rate",
    "engagement_score",
    "satisfaction_score",
    "price_sensitivity_index",
]
COMPARE_FEATURES = [
    "avg_order_value",
    "total_orders",
    "days_since_last_purchase",
    "engagement_score",
    "satisfaction_score",
    "return_rate",
    "cart_abandonment_rate",
    "discount_usage_rate",
    "customer_support_tickets",
]
