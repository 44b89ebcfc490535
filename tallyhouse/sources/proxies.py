"""Customer and order views over the generated star-schema tables.

``customers`` has one row per customer with an order before the cutoff, ``order_lines``
one row per line item, ``scored_customers`` adds a fixed cluster, score and tier.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.expressions import bin_right_closed, cents, from_cents
from tallyhouse.labels import TIER_EDGES, TIER_LABELS
from tallyhouse.sources.tables import table

CUTOFF = dt.date(2000, 8, 1)
HORIZON_DAYS = 365


def customers(
    spark: SparkSession, folder: str, cutoff: dt.date = CUTOFF, horizon_days: int = HORIZON_DAYS
) -> DataFrame:
    """Customer measures before the cutoff and the churn label after it.

    Every source is aggregated to its join key before it is joined, so a customer,
    order or user that holds a large share of the rows shrinks to one row per task
    before any shuffle. The line and event measures are left joins on unique keys:
    Catalyst drops them from queries that do not read their columns.
    """
    last_day = cutoff + dt.timedelta(days=horizon_days)
    day = F.col("o_orderdate").cast("date")
    before = day < F.lit(cutoff)
    orders = table(spark, folder, "orders").where(day < F.lit(last_day))
    per_customer = (
        orders.groupBy("o_custkey")
        .agg(
            F.min(F.when(before, day)).alias("first_day"),
            F.max(F.when(before, day)).alias("last_day"),
            F.count_if(before).alias("n_before"),
            F.sum(F.when(before, cents(F.col("o_totalprice")))).alias("value_cents"),
            F.count_if(~before).alias("n_after"),
        )
        .where("n_before > 0")
    )
    line_sums = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(cents(F.col("l_discount"))).alias("discount_cents"),
            F.count_if(F.col("l_discount") >= 0.05).alias("n_discounted"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
            F.sum(cents(F.col("l_quantity"))).alias("quantity_cents"),
        )
    )
    per_customer_lines = (
        orders.where(before)
        .select("o_orderkey", F.col("o_custkey").alias("line_custkey"))
        .join(line_sums, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("line_custkey")
        .agg(*[F.sum(c).alias(c) for c in line_sums.columns[1:]])
    )
    per_user = (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            *[
                F.count_if(F.col("event_type") == kind).alias(f"n_{kind}")
                for kind in ("view", "click", "purchase", "error")
            ],
        )
    )
    lines = F.col("n_lines").cast("double")
    carts = F.coalesce(F.col("n_click") + F.col("n_purchase"), F.lit(0))
    return_rate = F.col("n_returned") / lines
    return (
        per_customer.join(
            table(spark, folder, "customer", "c_custkey", "c_acctbal"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .join(per_customer_lines, F.col("c_custkey") == F.col("line_custkey"), "left")
        .join(per_user, F.expr("c_custkey div 10") == F.col("user_id"), "left")
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.when(F.col("c_acctbal") >= 5000, "Yes").otherwise("No").alias("loyalty_status"),
            (
                (F.lit(cutoff.year) - F.year("first_day")) * 12 + F.lit(cutoff.month) - F.month("first_day")
            ).alias("account_age_months"),
            F.col("n_before").cast("int").alias("total_orders"),
            F.datediff(F.lit(cutoff), "last_day").alias("days_since_last_purchase"),
            (from_cents(F.col("value_cents")) / F.col("n_before")).alias("avg_order_value"),
            (from_cents(F.col("discount_cents")) / lines * 10).alias("price_sensitivity_index"),
            (F.coalesce(F.col("n_view"), F.lit(0)) * 7 / F.lit(30.0)).alias("browsing_frequency_per_week"),
            F.when(carts > 0, F.col("n_click") / carts.cast("double"))
            .otherwise(0.0)
            .alias("cart_abandonment_rate"),
            (F.col("n_discounted") / lines).alias("discount_usage_rate"),
            return_rate.alias("return_rate"),
            F.coalesce(F.col("n_error"), F.lit(0)).cast("int").alias("customer_support_tickets"),
            (from_cents(F.col("quantity_cents")) / lines / 10).alias("product_review_score_avg"),
            F.least(F.lit(10.0), F.coalesce(F.col("n_events"), F.lit(0)) / F.lit(10.0)).alias(
                "engagement_score"
            ),
            (F.lit(10.0) * (F.lit(1.0) - return_rate)).alias("satisfaction_score"),
            (F.col("n_after") == 0).cast("int").alias("churned"),
        )
    )


def _line_columns() -> tuple[dict, dict, dict]:
    """Column expressions that read orders, parts, and the line itself."""
    ordered = F.col("o_orderdate").cast("date")
    from_orders = {
        "order_date": ordered,
        "payment_method": F.col("o_orderpriority"),
        "order_status": F.col("o_orderstatus"),
        "delivery_time_days": F.abs(F.datediff(F.col("l_shipdate").cast("date"), ordered)),
    }
    from_part = {"product_category": F.col("p_type"), "customer_age": F.col("p_size")}
    from_line = {
        "order_id": F.col("l_orderkey"),
        "line_number": F.col("l_linenumber"),
        "order_value": F.col("l_extendedprice"),
        "customer_rating": F.col("l_quantity") / F.lit(10.0),
        "discount_applied": (F.col("l_discount") > 0).cast("int"),
    }
    return from_orders, from_part, from_line


ORDER_COLUMNS = [
    "order_id",
    "order_date",
    "product_category",
    "payment_method",
    "order_status",
    "customer_age",
    "order_value",
    "delivery_time_days",
    "customer_rating",
    "discount_applied",
]


def order_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Order lines with the asked columns (all by default).

    Orders and parts are left joins on unique keys, so a side none of whose columns
    is asked for is not joined at all: the result is the same and a shuffle is saved.
    """
    wanted = columns or tuple(ORDER_COLUMNS)
    from_orders, from_part, from_line = _line_columns()
    frame = table(spark, folder, "lineitem")
    if any(c in from_orders for c in wanted):
        frame = frame.join(
            table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left"
        )
    if any(c in from_part for c in wanted):
        frame = frame.join(
            table(spark, folder, "part", "p_partkey", "p_type", "p_size"),
            F.col("l_partkey") == F.col("p_partkey"),
            "left",
        )
    known = {**from_orders, **from_part, **from_line}
    return frame.select(*[known[c].alias(c) for c in wanted])


def fixed_score() -> Column:
    """Fixed logistic expression over inactivity and engagement, unrounded."""
    z = F.lit(0.01) * (F.col("days_since_last_purchase") - 240) - F.lit(0.3) * (F.col("engagement_score") - 6)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def scored_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a fixed cluster (id modulo 4), churn score, prediction and tier."""
    raw = fixed_score()
    return (
        customers(spark, folder)
        .withColumn("cluster", F.pmod(F.col("customer_id").cast("long"), F.lit(4)).cast("int"))
        .withColumn("churn_score", F.round(raw, 6))
        .withColumn("churn_predicted", (raw > 0.5).cast("int"))
        .withColumn("risk_tier", bin_right_closed(raw, TIER_EDGES, TIER_LABELS))
    )
