"""Aggregations, descriptive statistics, churn comparisons and calendar reports."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Window, functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.labels import (
    COMPARE_FEATURES,
    CORRELATION_FEATURES,
    SEGMENT_FEATURES,
    TENURE_EDGES,
    TENURE_LABELS,
    WEEKDAY_ORDER,
)
from tallyhouse.operators import ranking, reshape as R, sampling, stats as S
from tallyhouse.plans.column_queries import TENURE_SQL
from tallyhouse.plans.load_queries import customer_table, line_table, scored_table
from tallyhouse.plans.registry import query, rounded
from tallyhouse.sources import proxies
from tallyhouse.sources.proxy_sql import PC, PO, PS, with_views
from tallyhouse.sources.tables import table

CENTS = "CAST(round({0} * 100) AS BIGINT)"
VALUE = CENTS.format("order_value")
STATUSES = ["F", "O", "P"]


def _mean_money(column: str):
    return X.from_cents(F.sum(X.cents(F.col(column)))) / F.count(column)


def _mean_money_sql(column: str) -> str:
    return f"CAST(sum({CENTS.format(column)}) AS DOUBLE) / 100 / count({column})"


# ---------------------------------------------------------------- counts, shares, means


@query(
    "agg_count",
    with_views(
        "SELECT (SELECT count(*) FROM pc) AS customers, (SELECT count(*) FROM orders) AS orders, "
        "(SELECT count(*) FROM lineitem) AS order_lines",
        PC,
    ),
)
def agg_count(spark, folder):
    parts = {
        "customers": proxies.customers(spark, folder),
        "orders": table(spark, folder, "orders"),
        "order_lines": table(spark, folder, "lineitem"),
    }
    rows = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
        rows = one if rows is None else rows.unionByName(one)
    side = lambda name: F.max(F.when(F.col("what") == name, F.col("n"))).alias(name)
    return rows.agg(*[side(name) for name in parts])


@query(
    "agg_count_if",
    with_views(
        """SELECT count(*) FILTER (WHERE churned = 1) AS churned, count(*) FILTER (WHERE churned = 0) AS active,
                  count(*) FILTER (WHERE churn_score >= 0.5) AS at_risk FROM ps""",
        PS,
    ),
)
def agg_count_if(spark, folder):
    return proxies.scored_customers(spark, folder).agg(
        F.count_if(F.col("churned") == 1).alias("churned"),
        F.count_if(F.col("churned") == 0).alias("active"),
        F.count_if(F.col("churn_score") >= 0.5).alias("at_risk"),
    )


@query("agg_group_count", "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def agg_group_count(spark, folder):
    return R.group_count(table(spark, folder, "events"), "event_type")


@query(
    "agg_group_share",
    """SELECT event_type, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 6) AS pct
       FROM events GROUP BY 1""",
)
def agg_group_share(spark, folder):
    return rounded(R.group_share(table(spark, folder, "events"), "event_type"))


@query(
    "agg_named",
    f"""SELECT o_orderpriority, count(o_orderkey) AS orders,
               round(CAST(sum({CENTS.format("o_totalprice")}) AS DOUBLE) / 100, 2) AS revenue,
               round({_mean_money_sql("o_totalprice")}, 6) AS avg_value FROM orders GROUP BY 1""",
)
def agg_named(spark, folder):
    return rounded(
        table(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count("o_orderkey").alias("orders"),
            X.from_cents(F.sum(X.cents(F.col("o_totalprice")))).alias("revenue"),
            _mean_money("o_totalprice").alias("avg_value"),
        )
    )


@query(
    "category_status",
    with_views(
        f"""SELECT product_category, order_status, count(*) AS total, round({_mean_money_sql("order_value")}, 4) AS avg_value
            FROM po GROUP BY 1, 2 ORDER BY 1, 2""",
        PO,
    ),
)
def category_status(spark, folder):
    lines = proxies.order_lines(spark, folder, "product_category", "order_status", "order_value")
    return rounded(
        lines.groupBy("product_category", "order_status")
        .agg(F.count(F.lit(1)).alias("total"), _mean_money("order_value").alias("avg_value")),
        4,
    ).orderBy("product_category", "order_status")


@query(
    "agg_multi_mean",
    with_views(
        f"""SELECT cluster, {", ".join(f"round(avg({c}), 6) AS {c}" for c in SEGMENT_FEATURES)} FROM ps GROUP BY cluster""",
        PS,
    ),
)
def agg_multi_mean(spark, folder):
    scored = proxies.scored_customers(spark, folder)
    return rounded(scored.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in SEGMENT_FEATURES]))


@query(
    "agg_rate",
    with_views(
        """SELECT cluster, round(avg(churned), 6) AS churn_rate,
                  round(avg(CASE WHEN loyalty_status = 'Yes' THEN 1 ELSE 0 END), 6) AS loyalty_rate
           FROM ps GROUP BY cluster""",
        PS,
    ),
)
def agg_rate(spark, folder):
    return rounded(
        proxies.scored_customers(spark, folder)
        .groupBy("cluster")
        .agg(
            X.rate(F.col("churned") == 1).alias("churn_rate"),
            X.rate(F.col("loyalty_status") == "Yes").alias("loyalty_rate"),
        )
    )


@query(
    "agg_global",
    with_views(
        """SELECT round(avg(engagement_score), 6) AS engagement_mean, round(avg(days_since_last_purchase), 6) AS days_mean,
                  min(days_since_last_purchase) AS days_min, max(days_since_last_purchase) AS days_max,
                  max(total_orders) AS most_orders FROM pc""",
        PC,
    ),
)
def agg_global(spark, folder):
    return rounded(
        proxies.customers(spark, folder).agg(
            F.avg("engagement_score").alias("engagement_mean"),
            F.avg("days_since_last_purchase").alias("days_mean"),
            F.min("days_since_last_purchase").alias("days_min"),
            F.max("days_since_last_purchase").alias("days_max"),
            F.max("total_orders").alias("most_orders"),
        )
    )


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL")
def distinct_values(spark, folder):
    return table(spark, folder, "part").select("p_brand", "p_type").na.drop().distinct()


@query(
    "agg_argmax",
    with_views(
        """SELECT (SELECT cluster FROM m ORDER BY days DESC, cluster LIMIT 1) AS most_inactive,
                  (SELECT cluster FROM m ORDER BY days, cluster LIMIT 1) AS most_active,
                  (SELECT round(max(days), 6) FROM m) AS max_days""",
        PS,
        "m AS (SELECT cluster, avg(days_since_last_purchase) AS days FROM ps GROUP BY cluster)",
    ),
)
def agg_argmax(spark, folder):
    means = (
        proxies.scored_customers(spark, folder)
        .groupBy("cluster")
        .agg(F.avg("days_since_last_purchase").alias("days"))
    )
    return rounded(
        means.agg(
            F.max_by("cluster", F.struct("days", -F.col("cluster"))).alias("most_inactive"),
            F.min_by("cluster", F.struct("days", "cluster")).alias("most_active"),
            F.max("days").alias("max_days"),
        )
    )


@query(
    "scalar_subquery_share",
    """SELECT o_orderstatus, count(*) AS orders,
              round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM orders), 6) AS pct FROM orders GROUP BY 1""",
)
def scalar_subquery_share(spark, folder):
    return spark.sql(
        """SELECT o_orderstatus, count(*) AS orders,
                  round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM {orders}), 6) AS pct
           FROM {orders} GROUP BY o_orderstatus""",
        orders=table(spark, folder, "orders"),
    )


@query(
    "reindex_order",
    """SELECT position, status AS o_orderstatus, orders
       FROM (VALUES (0, 'P'), (1, 'X'), (2, 'O'), (3, 'F')) AS wanted(position, status)
       LEFT JOIN (SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1) ON o_orderstatus = status""",
)
def reindex_order(spark, folder):
    """Counts in a fixed order; a listed status without rows stays, with null."""
    counted = R.group_count(table(spark, folder, "orders"), "o_orderstatus", name="orders")
    return R.reindex(counted, "o_orderstatus", ["P", "X", "O", "F"]).select("position", "o_orderstatus", "orders")


# ---------------------------------------------------------------- describe, quantiles


def _describe_sql(view: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75,
            round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {view}"""
        for c in columns
    )


CUSTOMER_STATS = [
    "account_age_months",
    "avg_order_value",
    "total_orders",
    "days_since_last_purchase",
    "engagement_score",
    "satisfaction_score",
    "churned",
]
ORDER_STATS = ["order_value", "delivery_time_days", "customer_rating", "customer_age"]


@query("describe_customers", with_views(_describe_sql("pc", CUSTOMER_STATS), PC))
def describe_customers(spark, folder):
    return rounded(S.describe(customer_table(spark, folder, *CUSTOMER_STATS), CUSTOMER_STATS))


@query("describe_orders", with_views(_describe_sql("po", ORDER_STATS), PO))
def describe_orders(spark, folder):
    return rounded(S.describe(line_table(spark, folder, *ORDER_STATS), ORDER_STATS))


@query(
    "agg_quantile",
    """SELECT o_orderpriority, 'o_totalprice' AS variable, round(quantile_cont(o_totalprice, 0.25), 6) AS p25,
              round(median(o_totalprice), 6) AS p50, round(quantile_cont(o_totalprice, 0.9), 6) AS p90
       FROM orders GROUP BY o_orderpriority""",
)
def agg_quantile(spark, folder):
    found = S.quantiles(table(spark, folder, "orders"), ["o_totalprice"], ["o_orderpriority"], (0.25, 0.5, 0.9))
    return rounded(found.withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p90"}))


@query(
    "eda_headline",
    with_views(
        """SELECT round(avg(avg_order_value), 6) AS value_mean, round(median(avg_order_value), 6) AS value_median,
                  round(avg(account_age_months), 6) AS tenure_mean,
                  round(avg(account_age_months) / 12, 6) AS tenure_years,
                  round(quantile_cont(CAST(account_age_months AS DOUBLE), 0.25), 6) AS tenure_p25,
                  (SELECT round(avg(customer_rating), 6) FROM po) AS rating_mean,
                  (SELECT round(avg(delivery_time_days), 6) FROM po) AS delivery_mean,
                  (SELECT max(delivery_time_days) FROM po) AS delivery_max
           FROM pc""",
        PC,
        PO,
    ),
)
def eda_headline(spark, folder):
    columns = ["avg_order_value", "account_age_months"]
    customers = S.describe(customer_table(spark, folder, *columns), columns)
    pick = lambda v, c: F.max(F.when(F.col("variable") == v, F.col(c)))
    left = customers.agg(
        pick("avg_order_value", "mean").alias("value_mean"),
        pick("avg_order_value", "p50").alias("value_median"),
        pick("account_age_months", "mean").alias("tenure_mean"),
        (pick("account_age_months", "mean") / 12).alias("tenure_years"),
        pick("account_age_months", "p25").alias("tenure_p25"),
    )
    row = (
        proxies.order_lines(spark, folder, "customer_rating", "delivery_time_days")
        .agg(
            F.avg("customer_rating").alias("rating_mean"),
            F.avg("delivery_time_days").alias("delivery_mean"),
            F.max("delivery_time_days").alias("delivery_max"),
        )
        .first()
    )
    return rounded(left.select("*", *[F.lit(row[c]).alias(c) for c in row.asDict()]))


@query(
    "category_counts",
    with_views(
        """SELECT 'product_category' AS variable, product_category AS value, count(*) AS count FROM po
           WHERE product_category IS NOT NULL GROUP BY 2
           UNION ALL SELECT 'payment_method', payment_method, count(*) FROM po WHERE payment_method IS NOT NULL GROUP BY 2
           UNION ALL SELECT 'order_status', order_status, count(*) FROM po WHERE order_status IS NOT NULL GROUP BY 2""",
        PO,
    ),
)
def category_counts(spark, folder):
    """Three value counts from one pass: combinations first, then one row per variable."""
    columns = ["product_category", "payment_method", "order_status"]
    combined = proxies.order_lines(spark, folder, *columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    long = combined.unpivot(["n"], columns, "variable", "value").where(F.col("value").isNotNull())
    return long.groupBy("variable", "value").agg(F.sum("n").alias("count"))


# ---------------------------------------------------------------- correlations


def _corr_sql(view: str, columns: list[str]) -> str:
    pairs = list(combinations(columns, 2))
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM {view}"
        for a, b in pairs
    )


@query(
    "corr_customers",
    with_views(
        "SELECT var1, var2, round(corr, 6) AS corr FROM (" + _corr_sql("pc", CORRELATION_FEATURES) + ")",
        PC.replace("\npc AS (", "\npc AS MATERIALIZED ("),
    ),
)
def corr_customers(spark, folder):
    return rounded(S.correlations(customer_table(spark, folder, *CORRELATION_FEATURES), CORRELATION_FEATURES))


@query(
    "corr_orders",
    with_views("SELECT var1, var2, round(corr, 6) AS corr FROM (" + _corr_sql("po", ORDER_STATS) + ")", PO),
)
def corr_orders(spark, folder):
    return rounded(S.correlations(line_table(spark, folder, *ORDER_STATS), ORDER_STATS))


@query(
    "corr_topk",
    with_views(
        "SELECT var1, var2, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM ("
        + _corr_sql("pc", CORRELATION_FEATURES)
        + f""") ORDER BY abs(corr) DESC, list_position({CORRELATION_FEATURES}, var1),
              list_position({CORRELATION_FEATURES}, var2) LIMIT 5""",
        PC.replace("\npc AS (", "\npc AS MATERIALIZED ("),
    ),
)
def corr_topk(spark, folder):
    return rounded(S.top_correlations(customer_table(spark, folder, *CORRELATION_FEATURES), CORRELATION_FEATURES, 5))


@query(
    "delivery_rating_points",
    with_views("SELECT order_id, line_number, delivery_time_days, customer_rating, order_status FROM po", PO),
)
def delivery_rating_points(spark, folder):
    """Delivery days against rating of every order, by status."""
    columns = ["order_id", "line_number", "delivery_time_days", "customer_rating", "order_status"]
    return proxies.order_lines(spark, folder, *columns).select(*columns)


# ---------------------------------------------------------------- churn


@query(
    "churn_distribution",
    with_views(
        """SELECT CASE churned WHEN 1 THEN 'Churned' ELSE 'Active' END AS state, count(*) AS customers,
                  round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM pc), 1) AS pct FROM pc GROUP BY churned""",
        PC,
    ),
)
def churn_distribution(spark, folder):
    shared = R.group_share(proxies.customers(spark, folder), "churned")
    return shared.select(
        X.flag_label(F.col("churned"), "Churned", "Active").alias("state"),
        F.col("count").alias("customers"),
        F.round("pct", 1).alias("pct"),
    )


_COMPARE_SQL = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS variable,
        round_even(avg(CASE WHEN churned = 0 THEN {c} END), 3) AS mean_active,
        round_even(avg(CASE WHEN churned = 1 THEN {c} END), 3) AS mean_churned FROM pc"""
    for i, c in enumerate(COMPARE_FEATURES)
)
_DIFF_SQL = "round_even((mean_churned - mean_active) / mean_active * 100, 1)"


@query(
    "group_mean_compare",
    with_views(f"SELECT variable, mean_active, mean_churned, {_DIFF_SQL} AS diff_pct FROM ({_COMPARE_SQL})", PC),
)
def group_mean_compare(spark, folder):
    return S.compare_groups(proxies.customers(spark, folder), COMPARE_FEATURES, "churned")


@query(
    "churn_top_driver",
    with_views(
        f"""SELECT variable, diff_pct FROM (SELECT *, {_DIFF_SQL} AS diff_pct FROM ({_COMPARE_SQL}))
            ORDER BY abs(diff_pct) DESC, position LIMIT 1""",
        PC,
    ),
)
def churn_top_driver(spark, folder):
    compared = S.compare_groups(proxies.customers(spark, folder), COMPARE_FEATURES, "churned")
    placed = compared.withColumn("position", X.ordinal(F.col("variable"), COMPARE_FEATURES))
    return ranking.winner(placed.withColumn("size", F.abs("diff_pct")), "size", "position").select(
        "variable", "diff_pct"
    )


def _churn_by(df, key):
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_if(F.col("churned") == 0).alias("active"),
        F.count_if(F.col("churned") == 1).alias("churned_count"),
        (F.avg("churned") * 100).alias("churned_pct"),
    )
    return rounded(counted.withColumn("active_pct", F.lit(100.0) - F.col("churned_pct")))


def _churn_by_sql(key: str, expression: str) -> str:
    return f"""SELECT {expression} AS {key}, count(*) FILTER (WHERE churned = 0) AS active,
        count(*) FILTER (WHERE churned = 1) AS churned_count, round(avg(churned) * 100, 6) AS churned_pct,
        round(100 - avg(churned) * 100, 6) AS active_pct FROM pc WHERE {expression} IS NOT NULL GROUP BY 1"""


@query("churn_by_loyalty", with_views(_churn_by_sql("loyalty_status", "loyalty_status"), PC))
def churn_by_loyalty(spark, folder):
    return _churn_by(proxies.customers(spark, folder), "loyalty_status")


def _with_band(df):
    return df.withColumn("age_group", X.bin_right_closed(F.col("account_age_months"), TENURE_EDGES, TENURE_LABELS))


@query("churn_by_tenure", with_views(_churn_by_sql("age_group", TENURE_SQL), PC))
def churn_by_tenure(spark, folder):
    return _churn_by(_with_band(proxies.customers(spark, folder)), "age_group")


@query(
    "churn_loyalty_x_tenure",
    with_views(
        "SELECT loyalty_status, "
        + ", ".join(f"""round(avg(churned) FILTER (WHERE band = '{b}') * 100, 4) AS "{b}\"""" for b in TENURE_LABELS)
        + f" FROM (SELECT *, {TENURE_SQL} AS band FROM pc) GROUP BY loyalty_status",
        PC,
    ),
)
def churn_loyalty_x_tenure(spark, folder):
    banded = _with_band(proxies.customers(spark, folder))
    return rounded(R.pivot_measure(banded, "loyalty_status", "age_group", TENURE_LABELS, F.avg("churned") * 100), 4)


# ---------------------------------------------------------------- calendar


def _monthly(spark, folder):
    day = F.col("order_date")
    lines = proxies.order_lines(spark, folder, "order_date", "order_value", "customer_rating", "order_id")
    per_month = lines.groupBy(F.year(day).alias("year"), F.month(day).alias("month_num")).agg(
        F.count("order_id").alias("orders"),
        X.from_cents(F.sum(X.cents(F.col("order_value")))).alias("revenue"),
        F.avg("customer_rating").alias("avg_rating"),
    )
    name = F.date_format(F.make_date("year", "month_num", F.lit(1)), "MMMM")
    return per_month.where(F.col("year").isNotNull()).withColumn("month_name", name)


_MONTHLY_SQL = f"""SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month_num,
    monthname(order_date) AS month_name, count(order_id) AS orders, CAST(sum({VALUE}) AS DOUBLE) / 100 AS revenue,
    avg(customer_rating) AS avg_rating FROM po WHERE order_date IS NOT NULL GROUP BY ALL"""


@query(
    "monthly_summary",
    with_views(
        f"""SELECT year, month_num, month_name, substr(month_name, 1, 3) AS month_short, orders, round(revenue, 2) AS revenue,
                   round(revenue / 1000, 6) AS revenue_k, round(avg_rating, 6) AS avg_rating
            FROM ({_MONTHLY_SQL}) ORDER BY year, month_num""",
        PO,
    ),
)
def monthly_summary(spark, folder):
    monthly = _monthly(spark, folder)
    return rounded(
        monthly.select(
            "year",
            "month_num",
            "month_name",
            F.substring("month_name", 1, 3).alias("month_short"),
            "orders",
            "revenue",
            (F.col("revenue") / 1000).alias("revenue_k"),
            "avg_rating",
        )
    ).orderBy("year", "month_num")


@query(
    "peak_low_month",
    with_views(
        """SELECT * FROM (SELECT 'peak' AS kind, year, month_name, orders, round(revenue, 2) AS revenue FROM m
                          ORDER BY orders DESC, year, month_num LIMIT 1)
           UNION ALL
           SELECT * FROM (SELECT 'low' AS kind, year, month_name, orders, round(revenue, 2) AS revenue FROM m
                          ORDER BY orders, year, month_num LIMIT 1)""",
        PO,
        f"m AS ({_MONTHLY_SQL})",
    ),
)
def peak_low_month(spark, folder):
    """Both ends in one aggregate over the months; the earlier month wins a tie."""
    row = F.struct("year", "month_name", "orders", F.round("revenue", 2).alias("revenue"))
    place = F.col("year") * 100 + F.col("month_num")
    ends = _monthly(spark, folder).agg(
        F.max_by(row, F.struct(F.col("orders"), -place)).alias("peak"),
        F.min_by(row, F.struct(F.col("orders"), place)).alias("low"),
    )
    return ends.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("kind"), *[F.col(f"{k}.{c}").alias(c) for c in ("year", "month_name", "orders", "revenue")])
                    for k in ("peak", "low")
                ]
            )
        )
    )


@query(
    "weekday_summary",
    with_views(
        f"""SELECT *, CASE WHEN row_number() OVER (ORDER BY orders DESC, position) = 1 THEN 1 ELSE 0 END AS best
            FROM (SELECT CAST(isodow(order_date) - 1 AS INTEGER) AS position, dayname(order_date) AS day_name,
                         count(order_id) AS orders, round({_mean_money_sql("order_value")}, 6) AS avg_value,
                         CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend
                  FROM po GROUP BY ALL)""",
        PO,
    ),
)
def weekday_summary(spark, folder):
    lines = proxies.order_lines(spark, folder, "order_id", "order_date", "order_value")
    stats = (
        lines.groupBy(F.date_format("order_date", "EEEE").alias("day_name"))
        .agg(F.count("order_id").alias("orders"), _mean_money("order_value").alias("avg_value"))
    )
    ordered = R.reindex(stats, "day_name", WEEKDAY_ORDER)
    rank = F.struct(F.col("orders"), -F.col("position"))
    first = F.max(rank).over(Window.partitionBy(F.lit(0)))  # seven rows; the earlier day wins a tie
    return rounded(
        ordered.select(
            "position",
            "day_name",
            "orders",
            "avg_value",
            F.col("day_name").isin("Saturday", "Sunday").cast("int").alias("is_weekend"),
            (rank == first).cast("int").alias("best"),
        )
    )


@query(
    "weekend_share",
    with_views(
        """SELECT round(avg(CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END) * 100, 6) AS weekend_pct FROM po""", PO
    ),
)
def weekend_share(spark, folder):
    lines = proxies.order_lines(spark, folder, "order_date")
    return rounded(lines.agg((F.avg(X.is_weekend(F.col("order_date"))) * 100).alias("weekend_pct")))


@query(
    "status_mix",
    with_views(
        """SELECT order_status, count(*) AS count, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM po), 6) AS pct
           FROM po GROUP BY order_status""",
        PO,
    ),
)
def status_mix(spark, folder):
    return rounded(R.group_share(proxies.order_lines(spark, folder, "order_status"), "order_status"))


@query(
    "pivot_mean",
    with_views(
        "SELECT product_category, "
        + ", ".join(
            f"""round(CAST(sum({VALUE}) FILTER (WHERE order_status = '{s}') AS DOUBLE) / 100
                / count(*) FILTER (WHERE order_status = '{s}'), 4) AS "{s}\""""
            for s in STATUSES
        )
        + " FROM po GROUP BY product_category",
        PO,
    ),
)
def pivot_mean(spark, folder):
    lines = proxies.order_lines(spark, folder, "product_category", "order_status", "order_value")
    return rounded(R.pivot_measure(lines, "product_category", "order_status", STATUSES, _mean_money("order_value")), 4)


# ---------------------------------------------------------------- chart data

_BOX_SQL = " UNION ALL ".join(
    f"""SELECT product_category, '{c}' AS variable, any_value(q1) AS q1, any_value(m) AS median, any_value(q3) AS q3,
        least(min({c}) FILTER (WHERE {c} >= q1 - 1.5::DOUBLE * (q3 - q1)), any_value(q1)) AS whisker_low,
        greatest(max({c}) FILTER (WHERE {c} <= q3 + 1.5::DOUBLE * (q3 - q1)), any_value(q3)) AS whisker_high,
        count(*) FILTER (WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers
        FROM (SELECT product_category, CAST({c} AS DOUBLE) AS {c} FROM po) JOIN
             (SELECT product_category, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
                     quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
              FROM po GROUP BY product_category) USING (product_category)
        GROUP BY product_category"""
    for c in ("customer_rating", "delivery_time_days")
)


@query(
    "box_stats",
    with_views(
        f"""SELECT product_category, variable, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
                   round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, outliers
            FROM ({_BOX_SQL})""",
        PO,
    ),
)
def box_stats(spark, folder):
    columns = ["customer_rating", "delivery_time_days"]
    lines = line_table(spark, folder, "product_category", *columns)
    return rounded(S.box_stats(lines, columns, "product_category"))


@query(
    "hist_equal_width",
    with_views(
        """SELECT bin, round(lo + bin * (hi - lo) / 30, 6) AS lower, round(lo + (bin + 1) * (hi - lo) / 30, 6) AS upper,
                  count(v) AS count, round(count(v) / (sum(count(v)) OVER () * (hi - lo) / 30), 10) AS density
           FROM (SELECT min(avg_order_value) AS lo, max(avg_order_value) AS hi FROM pc)
           CROSS JOIN (SELECT CAST(unnest(range(30)) AS INTEGER) AS bin)
           LEFT JOIN (SELECT avg_order_value AS v FROM pc)
                ON bin = CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INTEGER)
           GROUP BY bin, lo, hi""",
        PC,
    ),
)
def hist_equal_width(spark, folder):
    found = S.histogram(customer_table(spark, folder, "avg_order_value"), "avg_order_value", 30)
    return found.select(
        "bin",
        F.round("lower", 6).alias("lower"),
        F.round("upper", 6).alias("upper"),
        "count",
        F.round("density", 10).alias("density"),
    )


@query(
    "hist_density_by_class",
    with_views(
        """SELECT r.churned, bin, round(lo + bin * (hi - lo) / 40, 9) AS lower,
                  round(lo + (bin + 1) * (hi - lo) / 40, 9) AS upper, count(v) AS count,
                  round(count(v) / (sum(count(v)) OVER (PARTITION BY r.churned) * (hi - lo) / 40), 9) AS density
           FROM (SELECT churned, min(churn_score) AS lo, max(churn_score) AS hi FROM ps GROUP BY churned) r
           CROSS JOIN (SELECT CAST(unnest(range(40)) AS INTEGER) AS bin)
           LEFT JOIN (SELECT churned, churn_score AS v FROM ps) s
                ON s.churned = r.churned AND bin = CAST(least(floor((v - lo) / ((hi - lo) / 40)), 39) AS INTEGER)
           GROUP BY r.churned, bin, lo, hi""",
        PS,
    ),
)
def hist_density_by_class(spark, folder):
    scored = scored_table(spark, folder, "churned", "churn_score")
    return rounded(S.histogram(scored, "churn_score", 40, ["churned"], per_group_range=True), 9)


@query(
    "kde_by_class",
    with_views(
        """SELECT churned, point, round(x, 6) AS x, round(sum(copies * exp(-0.5::DOUBLE * ((x - center) / bw) * ((x - center) / bw))
                                           / (bw * 2.5066282746310002::DOUBLE * weight)), 8) AS density
           FROM (SELECT churned, CAST(point AS INTEGER) AS point, bw, weight, copies,
                        lo - 3 * bw + point * ((hi - lo + 6 * bw) / 199) AS x,
                        lo + (cell + 0.5::DOUBLE) * (hi - lo) / 2048 AS center
                 FROM (SELECT churned, lo, hi, bw, weight, count(*) AS copies,
                              least(floor((v - lo) / ((hi - lo) / 2048)), 2047) AS cell
                       FROM (SELECT churned, CAST(days_since_last_purchase AS DOUBLE) AS v FROM pc)
                       JOIN (SELECT churned, CAST(min(days_since_last_purchase) AS DOUBLE) AS lo,
                                    CAST(max(days_since_last_purchase) AS DOUBLE) AS hi,
                                    stddev_samp(days_since_last_purchase) * pow(count(*), -0.2::DOUBLE) AS bw,
                                    CAST(sum(count(*)) OVER () AS DOUBLE) AS weight FROM pc GROUP BY churned) USING (churned)
                       GROUP BY ALL),
                      range(200) AS grid(point))
           GROUP BY churned, point, x""",
        PC,
    ),
)
def kde_by_class(spark, folder):
    curve = S.density_curve(
        customer_table(spark, folder, "churned", "days_since_last_purchase"), "days_since_last_purchase", ["churned"]
    )
    return curve.select("churned", "point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query(
    "rank_average",
    """WITH m AS (SELECT c_nationkey, c_mktsegment, count(*) AS customers FROM customer GROUP BY 1, 2)
       SELECT c_nationkey, c_mktsegment, customers,
              rank() OVER (PARTITION BY c_mktsegment ORDER BY customers)
              + (count(*) OVER (PARTITION BY c_mktsegment, customers) - 1) / CAST(2 AS DOUBLE) AS rank FROM m""",
)
def rank_average(spark, folder):
    """Nations ranked by customers within each market segment; ties share the mean rank."""
    counted = R.group_count(table(spark, folder, "customer"), "c_nationkey", "c_mktsegment", name="customers")
    return counted.withColumn("rank", ranking.average_rank("customers", "c_mktsegment"))


# ---------------------------------------------------------------- chart data of several columns


def _columns_sql(columns: list[str], view: str, *groups: str) -> str:
    """CTE ``v``: one row per row and column."""
    names = ", ".join(f"'{c}'" for c in columns)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in columns)
    return f"v AS MATERIALIZED (SELECT {''.join(g + ', ' for g in groups)}unnest([{names}]) AS variable, unnest([{values}]) AS value FROM {view})"


def _hist_sql(bins: int, *keys: str) -> str:
    """Every bin of every group: a value belongs to the bin whose edges enclose it, the maximum to the last."""
    own, same = ", ".join(f"r.{k}" for k in keys), " AND ".join(f"v.{k} = r.{k}" for k in keys)
    return f"""SELECT {own}, bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper, count(value) AS count,
                      round(count(value) / (sum(count(value)) OVER (PARTITION BY {own}) * w), 8) AS density
               FROM (SELECT {", ".join(keys)}, min(value) AS lo, max(value) AS hi,
                            (max(value) - min(value)) / CAST({bins} AS DOUBLE) AS w FROM v GROUP BY ALL) r
               CROSS JOIN (SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin)
               LEFT JOIN v ON {same} AND value >= lo + bin * w AND (bin = {bins - 1} OR value < lo + (bin + 1) * w)
               GROUP BY {own}, bin, lo, w"""


def _kde_sql(*keys: str) -> str:
    """Gaussian kernels with Scott's bandwidth over 2048 cells; the groups of one variable share the weight."""
    k = ", ".join(keys)
    return f"""SELECT {k}, point, round(x, 6) AS x, round(sum(copies * exp(-0.5::DOUBLE * ((x - center) / bw) * ((x - center) / bw))
                                 / (bw * 2.5066282746310002::DOUBLE * weight)), 8) AS density
               FROM (SELECT {k}, CAST(point AS INTEGER) AS point, bw, weight, copies,
                            lo - 3 * bw + point * ((hi - lo + 6 * bw) / 199) AS x,
                            lo + (cell + 0.5::DOUBLE) * (hi - lo) / 2048 AS center
                     FROM (SELECT {k}, lo, hi, bw, weight, cell, count(*) AS copies FROM (
                             SELECT *, CASE WHEN value < lo + near * w THEN near - 1
                                            WHEN value >= lo + (near + 1) * w AND near < 2047 THEN near + 1 ELSE near END AS cell
                             FROM (SELECT *, least(floor((value - lo) / w), 2047) AS near
                                   FROM v JOIN (SELECT {k}, min(value) AS lo, max(value) AS hi,
                                                       (max(value) - min(value)) / CAST(2048 AS DOUBLE) AS w,
                                                       stddev_samp(value) * pow(count(value), -0.2::DOUBLE) AS bw,
                                                       CAST(sum(count(value)) OVER (PARTITION BY variable) AS DOUBLE) AS weight
                                                FROM v GROUP BY {k}) USING ({k})
                                   WHERE bw > 0))
                           GROUP BY ALL),
                          range(200) AS grid(point))
               GROUP BY {k}, point, x"""


def _box_sql(*keys: str) -> str:
    k = ", ".join(keys)
    return f"""SELECT {k}, round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3,
                      round(least(min(value) FILTER (WHERE value >= q1 - reach), q1), 6) AS whisker_low,
                      round(greatest(max(value) FILTER (WHERE value <= q3 + reach), q3), 6) AS whisker_high,
                      count(*) FILTER (WHERE value < q1 - reach OR value > q3 + reach) AS outliers
               FROM (SELECT *, 1.5::DOUBLE * (q3 - q1) AS reach FROM v JOIN
                       (SELECT {k}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS m,
                               quantile_cont(value, 0.75) AS q3 FROM v GROUP BY {k}) USING ({k}))
               GROUP BY {k}, q1, m, q3"""


# The columns and bin numbers of the reports.
CUSTOMER_CHARTS = [
    "avg_order_value", "total_orders", "account_age_months", "days_since_last_purchase", "engagement_score", "satisfaction_score",
]
ORDER_CHARTS = ["order_value", "delivery_time_days", "customer_rating"]
CHURN_CHARTS = [
    "avg_order_value", "total_orders", "days_since_last_purchase", "engagement_score", "satisfaction_score", "return_rate",
    "cart_abandonment_rate", "discount_usage_rate", "customer_support_tickets",
]
SEGMENT_CHARTS = ["avg_order_value", "engagement_score", "days_since_last_purchase", "satisfaction_score"]


def _bins(found):
    edges = {c: F.round(c, 6).alias(c) for c in ("lower", "upper")} | {"density": F.round("density", 8).alias("density")}
    return found.select(*[edges.get(c, F.col(c)) for c in found.columns])


def _points(curve):
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 8)})


@query("hist_customers", with_views(_hist_sql(30, "variable"), PC, _columns_sql(CUSTOMER_CHARTS, "pc")))
def hist_customers(spark, folder):
    return _bins(S.histograms(customer_table(spark, folder, *CUSTOMER_CHARTS), CUSTOMER_CHARTS, 30))


@query("hist_orders", with_views(_hist_sql(25, "variable"), PO, _columns_sql(ORDER_CHARTS, "po")))
def hist_orders(spark, folder):
    return _bins(S.histograms(line_table(spark, folder, *ORDER_CHARTS), ORDER_CHARTS, 25))


@query("kde_customers", with_views(_kde_sql("variable"), PC, _columns_sql(CUSTOMER_CHARTS, "pc")))
def kde_customers(spark, folder):
    return _points(S.density_curves(customer_table(spark, folder, *CUSTOMER_CHARTS), CUSTOMER_CHARTS))


@query("kde_orders", with_views(_kde_sql("variable"), PO, _columns_sql(ORDER_CHARTS, "po")))
def kde_orders(spark, folder):
    return _points(S.density_curves(line_table(spark, folder, *ORDER_CHARTS), ORDER_CHARTS))


@query("kde_churn_columns", with_views(_kde_sql("churned", "variable"), PC, _columns_sql(CHURN_CHARTS, "pc", "churned")))
def kde_churn_columns(spark, folder):
    return _points(S.density_curves(customer_table(spark, folder, "churned", *CHURN_CHARTS), CHURN_CHARTS, ["churned"]))


@query("box_engagement_by_churn", with_views(_box_sql("churned", "variable"), PC, _columns_sql(["engagement_score"], "pc", "churned")))
def box_engagement_by_churn(spark, folder):
    return rounded(S.box_stats(customer_table(spark, folder, "churned", "engagement_score"), ["engagement_score"], "churned"))


@query(
    "box_by_segment",
    with_views(_box_sql("cluster", "variable"), PS, _columns_sql([*SEGMENT_CHARTS, "churn_score"], "ps", "cluster")),
)
def box_by_segment(spark, folder):
    """Key variables and the score by segment."""
    columns = [*SEGMENT_CHARTS, "churn_score"]
    return rounded(S.box_stats(scored_table(spark, folder, "cluster", *columns), columns, "cluster"))


@query("hist_score_all", with_views(_hist_sql(50, "variable"), PS, _columns_sql(["churn_score"], "ps")))
def hist_score_all(spark, folder):
    return _bins(S.histograms(scored_table(spark, folder, "churn_score"), ["churn_score"], 50))


@query(
    "hist_score_test",
    with_views(
        _hist_sql(40, "churned", "variable"),
        PS,
        """test AS (SELECT * FROM ps QUALIFY row_number() OVER (PARTITION BY churned ORDER BY substr(md5(customer_id || ':42'), 1, 13))
                    > floor(CAST(0.8 AS DOUBLE) * count(*) OVER (PARTITION BY churned) + 0.5))""",
        _columns_sql(["churn_score"], "test", "churned"),
    ),
)
def hist_score_test(spark, folder):
    """Scores of the test rows by class."""
    rows = scored_table(spark, folder, "customer_id", "churned", "churn_score")
    test = sampling.stratified_split(rows, "churned", "customer_id", 0.8, 42).where("split = 'test'")
    return _bins(S.histograms(test, ["churn_score"], 40, ["churned"]))
