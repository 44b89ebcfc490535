"""Projections, filters, scalar functions and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.labels import RECOVERABLE_PATTERN, SEGMENT_NAMES, TENURE_EDGES, TENURE_LABELS
from tallyhouse.operators import reshape as R, sampling
from tallyhouse.operators import warehouse as W
from tallyhouse.plans.load_queries import (
    DIMS,
    FACTS,
    PSEG,
    fact_customers_frame,
    order_tables,
    scored_table,
    segmented,
)
from tallyhouse.plans.registry import query, rounded
from tallyhouse.sources import proxies
from tallyhouse.sources.proxy_sql import PC, PO, PS, with_views
from tallyhouse.sources.tables import table


@query(
    "project_rename",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_value FROM orders",
)
def project_rename(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_value"),
    )


@query(
    "case_label",
    with_views("SELECT customer_id, CASE churned WHEN 1 THEN 'Churned' ELSE 'Active' END AS state FROM pc", PC),
)
def case_label(spark, folder):
    flag = X.flag_label(F.col("churned"), "Churned", "Active")
    return proxies.customers(spark, folder).select("customer_id", flag.alias("state"))


@query(
    "flag_from_text",
    with_views(
        """SELECT customer_id, CASE WHEN loyalty_status = 'Yes' THEN 1 ELSE 0 END AS loyalty_member FROM pc""", PC
    ),
)
def flag_from_text(spark, folder):
    flag = X.flag_from_text(F.col("loyalty_status"))
    return proxies.customers(spark, folder).select("customer_id", flag.alias("loyalty_member"))


@query(
    "lookup_map",
    """WITH names AS (
         SELECT event_type, CAST(row_number() OVER (ORDER BY min(event_id), event_type) AS INTEGER) AS event_key
         FROM events WHERE event_type IN ('view', 'purchase', 'error') GROUP BY event_type)
       SELECT e.event_type, event_key, count(*) AS events
       FROM events e LEFT JOIN names n ON n.event_type = e.event_type GROUP BY e.event_type, event_key""",
)
def lookup_map(spark, folder):
    """Event names to keys; names that are not in the lookup keep a null key."""
    events = table(spark, folder, "events", "event_id", "event_type")
    known = events.where(F.col("event_type").isin("view", "purchase", "error"))
    lookup = W.lookup_dimensions(known, ["event_type"], "event_id")["event_type"]
    counted = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return W.map_lookup(counted, "event_type", lookup, "event_key").select("event_type", "event_key", "events")


@query(
    "filter_eq",
    with_views("SELECT customer_id, days_since_last_purchase FROM pc WHERE churned = 1", PC),
)
def filter_eq(spark, folder):
    customers = proxies.customers(spark, folder)
    return customers.where(F.col("churned") == 1).select("customer_id", "days_since_last_purchase")


@query(
    "filter_not_null",
    """SELECT c_custkey, n_events FROM customer
       JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id) ON user_id = c_custkey""",
)
def filter_not_null(spark, folder):
    per_user = table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    joined = table(spark, folder, "customer").join(per_user, F.col("c_custkey") == F.col("user_id"), "left")
    return joined.na.drop(subset=["n_events"]).select("c_custkey", "n_events")


@query(
    "str_prefix",
    """SELECT substr(monthname(o_orderdate), 1, 3) AS month_short, count(*) AS orders FROM orders GROUP BY 1""",
)
def str_prefix(spark, folder):
    short = F.substring(F.date_format("o_orderdate", "MMMM"), 1, 3)
    return table(spark, folder, "orders").groupBy(short.alias("month_short")).agg(F.count(F.lit(1)).alias("orders"))


def _name_case(column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in SEGMENT_NAMES.items()) + " END"


@query(
    "str_regex_filter",
    with_views(
        f"""SELECT segment_name, count(*) AS customers FROM (SELECT {_name_case("segment")} AS segment_name FROM seg)
            WHERE regexp_matches(segment_name, '{RECOVERABLE_PATTERN}') GROUP BY segment_name""",
        PSEG,
    ),
)
def str_regex_filter(spark, folder):
    named = segmented(spark, folder).select(X.rename_values(F.col("segment"), SEGMENT_NAMES).alias("segment_name"))
    hits = named.where(F.col("segment_name").rlike(RECOVERABLE_PATTERN))
    return R.group_count(hits, "segment_name", name="customers")


@query(
    "date_parse",
    """SELECT o_orderstatus, count(parsed) AS parsed, count(*) - count(parsed) AS failed,
              min(parsed) AS first_day, max(parsed) AS last_day
       FROM (SELECT o_orderstatus,
                    try_cast(CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END
                             AS DATE) AS parsed FROM orders)
       GROUP BY o_orderstatus""",
)
def date_parse(spark, folder):
    """Dates from text, with one priority written unreadably: bad text is null, not an error."""
    text = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    parsed = table(spark, folder, "orders").select("o_orderstatus", text.try_cast("date").alias("parsed"))
    return parsed.groupBy("o_orderstatus").agg(
        F.count("parsed").alias("parsed"),
        F.count_if(F.col("parsed").isNull()).alias("failed"),
        F.min("parsed").alias("first_day"),
        F.max("parsed").alias("last_day"),
    )


@query(
    "date_format_key",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS full_date,
              CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id FROM orders""",
)
def date_format_key(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("full_date"),
        X.date_key(F.col("o_orderdate").cast("date")).alias("date_id"),
    )


@query(
    "date_parts",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
              CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
              CAST(strftime(o_orderdate, '%W') AS INTEGER) AS week_of_year,
              CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, count(*) AS orders
       FROM orders GROUP BY ALL""",
)
def date_parts(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return (
        table(spark, folder, "orders")
        .groupBy(
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day_of_month"),
            X.monday_week(day).alias("week_of_year"),
            X.weekday_from_monday(day).alias("day_of_week"),
        )
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "round_modes",
    """SELECT o_orderpriority, round(v, 2) AS half_up, round_even(v, 2) AS half_even
       FROM (SELECT o_orderpriority,
                    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS v
             FROM orders GROUP BY o_orderpriority)""",
)
def round_modes(spark, folder):
    value = X.from_cents(F.sum(X.cents(F.col("o_totalprice")))) / F.count(F.lit(1))
    means = table(spark, folder, "orders").groupBy("o_orderpriority").agg(value.alias("v"))
    return means.select("o_orderpriority", F.round("v", 2).alias("half_up"), F.bround("v", 2).alias("half_even"))


@query(
    "pct_diff",
    """WITH y AS (
         SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
                CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS f,
                CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS o
         FROM orders GROUP BY 1)
       SELECT order_year, round((o - f) / f * 100, 6) AS diff_pct, round(f / (f + o) * 100, 6) AS share_pct FROM y""",
)
def pct_diff(spark, folder):
    side = lambda s: X.from_cents(F.sum(F.when(F.col("o_orderstatus") == s, X.cents(F.col("o_totalprice")))))
    years = (
        table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("order_year"))
        .agg(side("F").alias("f"), side("O").alias("o"))
    )
    return rounded(
        years.select(
            "order_year",
            X.percent_change(F.col("f"), F.col("o")).alias("diff_pct"),
            X.percent(F.col("f"), F.col("f") + F.col("o")).alias("share_pct"),
        )
    )


@query(
    "unit_scale",
    with_views(
        """SELECT customer_id, account_age_months / CAST(12 AS DOUBLE) AS years, avg_order_value / 1000 AS value_k,
                  churn_score * 120 + 10 AS marker FROM ps""",
        PS,
    ),
)
def unit_scale(spark, folder):
    return proxies.scored_customers(spark, folder).select(
        "customer_id",
        (F.col("account_age_months") / 12).alias("years"),
        (F.col("avg_order_value") / 1000).alias("value_k"),
        (F.col("churn_score") * 120 + 10).alias("marker"),
    )


TENURE_SQL = """CASE WHEN account_age_months <= 0 THEN NULL WHEN account_age_months <= 12 THEN '0-12m'
  WHEN account_age_months <= 24 THEN '13-24m' WHEN account_age_months <= 36 THEN '25-36m'
  WHEN account_age_months <= 60 THEN '37-60m' WHEN account_age_months <= 999 THEN '60m+' END"""


@query(
    "bin_right_closed",
    with_views(
        f"""SELECT customer_id, {TENURE_SQL} AS band,
                   CAST(list_position({TENURE_LABELS}, {TENURE_SQL}) - 1 AS INTEGER) AS position FROM pc""",
        PC,
    ),
)
def bin_right_closed(spark, folder):
    age = F.col("account_age_months")
    return proxies.customers(spark, folder).select(
        "customer_id",
        X.bin_right_closed(age, TENURE_EDGES, TENURE_LABELS).alias("band"),
        X.bin_index(age, TENURE_EDGES).alias("position"),
    )


@query(
    "risk_tiers",
    with_views("SELECT customer_id, churn_score, coalesce(risk_tier, 'nan') AS risk_tier FROM ps", PS),
)
def risk_tiers(spark, folder):
    scored = proxies.scored_customers(spark, folder)
    return scored.select("customer_id", "churn_score", X.text_or(F.col("risk_tier")).alias("risk_tier"))


@query(
    "format_pct",
    with_views(
        """SELECT loyalty_status, round(avg(churned) * 100, 6) AS churn_pct,
                  printf('%.1f%%', avg(churned) * 100) AS churn_text FROM pc GROUP BY loyalty_status""",
        PC,
    ),
)
def format_pct(spark, folder):
    rate = F.avg("churned") * 100
    return rounded(
        proxies.customers(spark, folder)
        .groupBy("loyalty_status")
        .agg(rate.alias("churn_pct"), F.format_string("%.1f%%", rate).alias("churn_text"))
    )


@query(
    "join_inner",
    "SELECT o_orderkey, c_custkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(spark, folder):
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_custkey", "c_mktsegment", "o_totalprice"
    )


@query(
    "join_dim",
    with_views("SELECT loyalty_status AS status_name, count(*) AS customers FROM pc GROUP BY loyalty_status", PC),
)
def join_dim(spark, folder):
    """Facts counted per foreign key first, so the join reads one row per key."""
    counted = R.group_count(fact_customers_frame(spark, folder), "loyalty_status_id", name="customers")
    return counted.join(W.loyalty_dimension(spark), "loyalty_status_id").select("status_name", "customers")


@query(
    "join_star",
    with_views(
        """SELECT CAST(year(order_date) AS INTEGER) AS year, c.name AS product_category, m.name AS payment_method,
                  s.name AS order_status, count(*) AS orders
           FROM fact JOIN dims c ON c.lookup = 'product_category' AND c.key = product_category_id
           JOIN dims m ON m.lookup = 'payment_method' AND m.key = payment_method_id
           JOIN dims s ON s.lookup = 'order_status' AND s.key = order_status_id
           GROUP BY ALL""",
        PO,
        DIMS,
        FACTS,
    ),
)
def join_star(spark, folder):
    facts, dims = order_tables(spark, folder)
    dates = W.date_dimension(table(spark, folder, "orders", "o_orderdate"), "o_orderdate")
    view = W.orders_view(facts, dates, dims)
    return R.group_count(view, "year", "product_category", "payment_method", "order_status", name="orders")


@query(
    "join_left_anti",
    """SELECT p_partkey, p_name FROM part LEFT JOIN
              (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-03-01') ON l_partkey = p_partkey
       WHERE l_partkey IS NULL""",
)
def join_left_anti(spark, folder):
    """Parts that were not shipped since a date."""
    shipped = table(spark, folder, "lineitem").where("l_shipdate >= TIMESTAMP '2001-03-01'").select("l_partkey").distinct()
    parts = table(spark, folder, "part", "p_partkey", "p_name")
    return parts.join(shipped, F.col("p_partkey") == F.col("l_partkey"), "left_anti")


@query(
    "join_left",
    with_views("SELECT customer_id, churned, CASE WHEN account_age_months > 60 THEN cluster END AS cluster_id FROM ps", PS),
)
def join_left(spark, folder):
    """Every customer with the stored cluster, null where none is stored."""
    base = scored_table(spark, folder, "customer_id", "churned", "cluster", "account_age_months")
    segments = base.where("account_age_months > 60").select("customer_id", F.col("cluster").alias("cluster_id"))
    return base.join(segments, "customer_id", "left").select("customer_id", "churned", "cluster_id")


@query(
    "set_except",
    "SELECT DISTINCT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'",
)
def set_except(spark, folder):
    """Customers that had not ordered before a date."""
    early = table(spark, folder, "orders").where("o_orderdate < TIMESTAMP '1996-01-01'")
    buyers = early.select(F.col("o_custkey").alias("id")).distinct()
    everyone = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    return everyone.subtract(buyers)


@query(
    "sort_multi",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM orders GROUP BY 1, 2
       ORDER BY orders DESC, o_orderpriority, o_orderstatus""",
)
def sort_multi(spark, folder):
    counted = R.group_count(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", name="orders")
    return counted.orderBy(F.desc("orders"), "o_orderpriority", "o_orderstatus")


@query(
    "sample_fixed",
    with_views(
        """SELECT customer_id, churned FROM pc
           ORDER BY substr(md5(customer_id || ':42'), 1, 13), customer_id LIMIT 500""",
        PC,
    ),
)
def sample_fixed(spark, folder):
    return sampling.sample_fixed(proxies.customers(spark, folder).select("customer_id", "churned"), "customer_id", 500)


