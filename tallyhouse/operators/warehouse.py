"""Dimension, fact and view builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.config import SMALL_ROWS, local_frame, settle
from tallyhouse.functions import expressions as X
from tallyhouse.labels import LOYALTY_ROWS
from tallyhouse.operators.ranking import number_rows
from tallyhouse.schemas import DIM_LOYALTY

CUSTOMER_MEASURES = [
    "account_age_months",
    "total_orders",
    "days_since_last_purchase",
    "avg_order_value",
    "price_sensitivity_index",
    "browsing_frequency_per_week",
    "cart_abandonment_rate",
    "discount_usage_rate",
    "return_rate",
    "customer_support_tickets",
    "product_review_score_avg",
    "engagement_score",
    "satisfaction_score",
]
ORDER_MEASURES = ["customer_age", "order_value", "delivery_time_days", "customer_rating", "discount_applied"]

# source column -> (table, key column, name column)
ORDER_LOOKUPS = {
    "product_category": ("dim_product_category", "product_category_id", "category_name"),
    "payment_method": ("dim_payment_method", "payment_method_id", "method_name"),
    "order_status": ("dim_order_status", "order_status_id", "status_name"),
}


def date_dimension(dates: DataFrame, column: str) -> DataFrame:
    """One row per distinct date present; gaps are not filled."""
    day = F.col("full_date")
    return (
        dates.select(F.col(column).cast("date").alias("full_date"))
        .where(day.isNotNull())
        .distinct()
        .select(
            X.date_key(day).alias("date_id"),
            "full_date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            X.monday_week(day).alias("week_of_year"),
            F.dayofmonth(day).alias("day_of_month"),
            X.weekday_from_monday(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            X.is_weekend(day).alias("is_weekend"),
        )
    )


def lookup_dimensions(
    df: DataFrame, columns: Sequence[str], order_by: str, max_rows: int = SMALL_ROWS
) -> dict[str, DataFrame]:
    """Surrogate keys in order of first appearance, all lookups in one pass over ``df``.

    Files have no row order in Spark, so appearance is the smallest ``order_by`` (a
    number, which keeps the aggregation hash based); names that first appear together
    are numbered alphabetically.
    """
    cells = [F.struct(F.lit(c).alias("lookup"), F.col(c).alias("name")) for c in columns]
    seen = (
        df.select(F.col(order_by).alias("place"), F.inline(F.array(*cells)))
        .where(F.col("name").isNotNull())
        .groupBy("lookup", "name")
        .agg(F.min("place").alias("first_place"))
    )
    seen = settle(seen, max_rows)
    numbered = {}
    for c in columns:
        names = seen.where(F.col("lookup") == c).select("name", "first_place")
        keyed = number_rows(names, ["first_place", "name"], "key", max_rows, heavy=False)
        numbered[c] = settle(keyed.select(F.col("key").cast("int").alias("key"), "name"), max_rows)
    return numbered


def loyalty_dimension(spark: SparkSession) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(LOYALTY_ROWS, start=1)]
    return local_frame(spark, rows, DIM_LOYALTY)


def map_lookup(df: DataFrame, column: str, lookup: DataFrame, key: str) -> DataFrame:
    """Add ``key`` for the name in ``column``; an unknown or null name gives null."""
    names = settle(lookup.select(F.col("key").alias(key), F.col("name").alias(f"_{column}")))
    return df.join(names, F.col(column) == F.col(f"_{column}"), "left").drop(f"_{column}")


def customer_facts(customers: DataFrame, loyalty: DataFrame) -> DataFrame:
    lookup = loyalty.select(F.col("loyalty_status_id").alias("key"), F.col("status_name").alias("name"))
    return map_lookup(customers, "loyalty_status", lookup, "loyalty_status_id").select(
        "customer_id", "loyalty_status_id", *CUSTOMER_MEASURES, "churned"
    )


def order_facts(orders: DataFrame, lookups: dict[str, DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """Names swapped for keys; the date key is computed, it needs no lookup."""
    frame = orders
    for column, (_, key, _) in ORDER_LOOKUPS.items():
        frame = map_lookup(frame, column, lookups[column], key)
    return frame.select(
        "order_id",
        *extra,
        X.date_key(F.col("order_date")).alias("date_id"),
        *[key for _, key, _ in ORDER_LOOKUPS.values()],
        *ORDER_MEASURES,
    )


def split_rejects(facts: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column, and the rest."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    return facts.where(complete), facts.where(~complete)


def customers_view(facts: DataFrame, loyalty: DataFrame) -> DataFrame:
    names = settle(loyalty.select("loyalty_status_id", F.col("status_name").alias("loyalty_status")))
    return facts.join(names, "loyalty_status_id").select(
        "customer_id",
        "loyalty_status",
        *CUSTOMER_MEASURES,
        X.flag_label(F.col("churned")).alias("churned"),
    )


def orders_view(
    facts: DataFrame, dates: DataFrame, dims: dict[str, DataFrame], extra: Sequence[str] = ()
) -> DataFrame:
    """Labels instead of keys; ``dims`` maps source column -> (key, name) frame."""
    calendar = settle(
        dates.select("date_id", F.col("full_date").alias("order_date"), "year", "month_name", "day_name", "is_weekend")
    )
    frame = facts.join(calendar, "date_id")
    for column, (_, key, _) in ORDER_LOOKUPS.items():
        names = settle(dims[column].select(F.col("key").alias(key), F.col("name").alias(column)))
        frame = frame.join(names, key)
    return frame.select(
        "order_id",
        *extra,
        "order_date",
        "year",
        "month_name",
        "day_name",
        "is_weekend",
        *ORDER_LOOKUPS,
        "customer_age",
        "order_value",
        "delivery_time_days",
        "customer_rating",
        X.flag_label(F.col("discount_applied")).alias("discount_applied"),
    )


def training_table(facts: DataFrame, loyalty: DataFrame, segments: DataFrame) -> DataFrame:
    """Customer facts with loyalty as 1/0 and, where known, the segment."""
    member = X.flag_from_text(F.col("status_name")).alias("loyalty_member")
    measures = [c for c in CUSTOMER_MEASURES if c != "discount_usage_rate"]
    return (
        facts.join(settle(loyalty), "loyalty_status_id")
        .join(segments.select("customer_id", "segment_name"), "customer_id", "left")
        .select("customer_id", *measures, "churned", member, "segment_name")
    )


def master_table(
    facts: DataFrame, loyalty: DataFrame, segments: DataFrame, scores: DataFrame
) -> DataFrame:
    """Facts, loyalty name, segment and score of every customer that has all three."""
    return (
        facts.join(settle(loyalty.select("loyalty_status_id", "status_name")), "loyalty_status_id")
        .join(segments.select("customer_id", "segment_name"), "customer_id")
        .join(scores, "customer_id")
        .select(
            "customer_id",
            "segment_name",
            "risk_tier",
            "churn_score",
            "churn_predicted",
            "avg_order_value",
            "total_orders",
            "days_since_last_purchase",
            "engagement_score",
            "satisfaction_score",
            "customer_support_tickets",
            "churned",
            F.col("status_name").alias("loyalty_status"),
        )
    )
