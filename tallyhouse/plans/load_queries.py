"""Scans, sinks, dimensions, facts and views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.config import scratch_path, stored
from tallyhouse.functions import expressions as X
from tallyhouse.operators import warehouse as W
from tallyhouse.plans.registry import query
from tallyhouse.sources import proxies, sinks
from tallyhouse.sources.proxy_sql import PC, PO, PS, with_views
from tallyhouse.sources.tables import scan_csv, table

MEASURES = ", ".join(W.CUSTOMER_MEASURES)

# Surrogate keys in order of first appearance, as SQL.
DIMS = """seen AS (
  SELECT 'product_category' AS lookup, product_category AS name, min(order_id) AS place
  FROM po WHERE product_category IS NOT NULL GROUP BY product_category
  UNION ALL
  SELECT 'payment_method', payment_method, min(order_id)
  FROM po WHERE payment_method IS NOT NULL GROUP BY payment_method
  UNION ALL
  SELECT 'order_status', order_status, min(order_id)
  FROM po WHERE order_status IS NOT NULL GROUP BY order_status),
dims AS (
  SELECT lookup, name, CAST(row_number() OVER (PARTITION BY lookup ORDER BY place, name) AS INTEGER) AS key FROM seen)"""

FACTS = """fact AS (
  SELECT order_id, line_number, order_date,
         CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_id,
         c.key AS product_category_id, m.key AS payment_method_id, s.key AS order_status_id,
         customer_age, order_value, delivery_time_days, customer_rating, discount_applied
  FROM po
  LEFT JOIN dims c ON c.lookup = 'product_category' AND c.name = product_category
  LEFT JOIN dims m ON m.lookup = 'payment_method' AND m.name = payment_method
  LEFT JOIN dims s ON s.lookup = 'order_status' AND s.name = order_status)"""


def order_dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    columns = list(W.ORDER_LOOKUPS)
    lines = proxies.order_lines(spark, folder, "order_id", *columns)
    return W.lookup_dimensions(lines, columns, "order_id")


def order_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Facts and lookups of the orders, both from one stored join of lines, orders and parts."""
    lines = line_table(spark, folder, "line_number", *proxies.ORDER_COLUMNS)
    dims = W.lookup_dimensions(lines, list(W.ORDER_LOOKUPS), "order_id")
    return W.order_facts(lines, dims, ["line_number"]), dims


def fact_customers_frame(spark: SparkSession, folder: str) -> DataFrame:
    return W.customer_facts(proxies.customers(spark, folder), W.loyalty_dimension(spark))


def customer_table(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Customer measures written once, for reports that pass over them more than once."""
    frame = proxies.customers(spark, folder)
    return stored(frame.select(*columns) if columns else frame, "customers")


def scored_table(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    frame = proxies.scored_customers(spark, folder)
    return stored(frame.select(*columns) if columns else frame, "scored")


def line_table(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return stored(proxies.order_lines(spark, folder, *columns), "lines")


@query("scan_parquet", "SELECT * FROM customer")
def scan_parquet(spark, folder):
    return table(spark, folder, "customer")


@query("scan_pruned", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def scan_pruned(spark, folder):
    frame = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return frame.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "scan_csv_roundtrip",
    with_views(f"SELECT customer_id, loyalty_status AS loyalty_member, {MEASURES}, '' AS bad_fields FROM pc", PC),
)
def scan_csv_roundtrip(spark, folder):
    """Customers written as CSV with a header and read back under the declared schema."""
    path = scratch_path(spark, "features-csv")
    features = proxies.customers(spark, folder).withColumnsRenamed(
        {"customer_id": "Customer_ID", "loyalty_status": "loyalty_member"}
    )
    features.select(*schemas.CSV_FEATURES.fieldNames()).write.option("header", True).csv(path)
    back = scan_csv(spark, path, schemas.CSV_FEATURES, bad_rows="bad_fields")
    return back.withColumnRenamed("Customer_ID", "customer_id")


@query(
    "sink_append",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders FROM orders GROUP BY 1",
)
def sink_append(spark, folder):
    """Orders appended to one table in two batches."""
    path = scratch_path(spark, "append")
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("order_year"))
    sinks.append(orders.where("order_year < 1998"), path)
    sinks.append(orders.where("order_year >= 1998"), path)
    return spark.read.parquet(path).groupBy("order_year").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "sink_overwrite",
    with_views(
        """SELECT cluster AS cluster_id, count(*) AS customers,
                  CAST(sum(CASE WHEN cluster = 1 THEN 1 ELSE 0 END) AS BIGINT) AS reloaded
           FROM ps GROUP BY cluster""",
        PS,
    ),
)
def sink_overwrite(spark, folder):
    """Segments stored by cluster, loaded twice; then only one partition is replaced."""
    path = scratch_path(spark, "reload")
    rows = proxies.scored_customers(spark, folder).select(
        "customer_id", F.lit(0).alias("version"), F.col("cluster").alias("cluster_id")
    )
    sinks.overwrite(rows, path, ["cluster_id"])
    sinks.overwrite(rows, path, ["cluster_id"])
    again = rows.where("cluster_id = 1").withColumn("version", F.lit(1))
    sinks.overwrite(again, path, ["cluster_id"], only_present=True)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("cluster_id").cast("int").alias("cluster_id"))
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("version").alias("reloaded"))
    )


@query(
    "sink_truncate",
    with_views("SELECT cluster AS cluster_id, count(*) AS customers FROM ps WHERE cluster IN (1, 2) GROUP BY cluster", PS),
)
def sink_truncate(spark, folder):
    """All segments stored by cluster, then reloaded with two of them: the others are gone."""
    path = scratch_path(spark, "truncate")
    rows = proxies.scored_customers(spark, folder).select("customer_id", F.col("cluster").alias("cluster_id"))
    sinks.overwrite(rows, path, ["cluster_id"])
    sinks.overwrite(rows.where("cluster_id IN (1, 2)"), path, ["cluster_id"])
    stored_rows = spark.read.parquet(path).groupBy(F.col("cluster_id").cast("int").alias("cluster_id"))
    return stored_rows.agg(F.count(F.lit(1)).alias("customers"))


@query(
    "upsert_new_keys",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders
       WHERE CAST(o_orderdate AS DATE) NOT IN
             (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""",
)
def upsert_new_keys(spark, folder):
    """Dates to insert when those of urgent pending orders are stored already."""
    orders = table(spark, folder, "orders").withColumn("full_date", F.col("o_orderdate").cast("date"))
    known = orders.where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select("full_date")
    return sinks.new_keys(orders.select("full_date"), known, ["full_date"])


@query(
    "inline_values",
    with_views(
        """SELECT loyalty_status_id, status_name, description, count(customer_id) AS customers
           FROM (VALUES (1, 'Yes', 'Loyalty Member'), (2, 'No', 'Regular Customer'))
                AS dim(loyalty_status_id, status_name, description)
           LEFT JOIN pc ON loyalty_status = status_name GROUP BY ALL""",
        PC,
    ),
)
def inline_values(spark, folder):
    """The two literal loyalty rows with the customers that carry each."""
    members = proxies.customers(spark, folder).groupBy("loyalty_status").agg(F.count("customer_id").alias("customers"))
    return W.loyalty_dimension(spark).join(members, F.col("status_name") == F.col("loyalty_status"), "left").select(
        "loyalty_status_id", "status_name", "description", F.coalesce("customers", F.lit(0)).alias("customers")
    )


@query(
    "load_report",
    with_views(
        """SELECT 'dim_date' AS target, (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders) AS rows_written
           UNION ALL SELECT 'fact_customers', (SELECT count(*) FROM pc)
           UNION ALL SELECT 'fact_orders', (SELECT count(*) FROM lineitem)""",
        PC,
    ),
)
def load_report(spark, folder):
    """Rows written per target, counted by the writing pass itself."""
    orders = table(spark, folder, "orders")
    targets = {
        "dim_date": W.date_dimension(orders, "o_orderdate"),
        "fact_customers": fact_customers_frame(spark, folder),
        "fact_orders": order_tables(spark, folder)[0],
    }
    rows = [(name, sinks.write_counted(df, scratch_path(spark, name))) for name, df in targets.items()]
    return spark.createDataFrame(rows, "target string, rows_written bigint")


@query(
    "dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
              CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
              CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
              CAST(strftime(d, '%W') AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
              CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
              CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
       FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def dim_date(spark, folder):
    return W.date_dimension(table(spark, folder, "orders", "o_orderdate"), "o_orderdate")


@query("dim_lookup", with_views("SELECT lookup, key, name FROM dims", PO, DIMS))
def dim_lookup(spark, folder):
    dims = order_dimensions(spark, folder)
    frames = [df.select(F.lit(c).alias("lookup"), "key", "name") for c, df in dims.items()]
    return reduce(DataFrame.unionByName, frames)


@query(
    "fact_customers",
    with_views(
        f"""SELECT customer_id, CASE loyalty_status WHEN 'Yes' THEN 1 WHEN 'No' THEN 2 END AS loyalty_status_id,
                   {MEASURES}, churned FROM pc""",
        PC,
    ),
)
def fact_customers(spark, folder):
    return fact_customers_frame(spark, folder)


@query("fact_orders", with_views("SELECT * EXCLUDE (order_date) FROM fact", PO, DIMS, FACTS))
def fact_orders(spark, folder):
    return order_tables(spark, folder)[0]


@query(
    "vw_customers",
    with_views(
        f"""SELECT customer_id, loyalty_status, {MEASURES},
                   CASE churned WHEN 1 THEN 'Yes' ELSE 'No' END AS churned FROM pc""",
        PC,
    ),
)
def vw_customers(spark, folder):
    return W.customers_view(fact_customers_frame(spark, folder), W.loyalty_dimension(spark))


@query(
    "vw_orders",
    with_views(
        """SELECT order_id, line_number, order_date, CAST(year(order_date) AS INTEGER) AS year,
                  monthname(order_date) AS month_name, dayname(order_date) AS day_name,
                  CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
                  product_category, payment_method, order_status, customer_age, order_value,
                  delivery_time_days, customer_rating,
                  CASE discount_applied WHEN 1 THEN 'Yes' ELSE 'No' END AS discount_applied
           FROM po""",
        PO,
    ),
)
def vw_orders(spark, folder):
    facts, dims = order_tables(spark, folder)
    dates = W.date_dimension(table(spark, folder, "orders", "o_orderdate"), "o_orderdate")
    return W.orders_view(facts, dates, dims, ["line_number"])


SEGMENT_CASE = """CASE cluster WHEN 0 THEN 'high_value' WHEN 1 THEN 'loyal' WHEN 2 THEN 'price_hunter'
                  ELSE 'at_risk' END"""
CLUSTER_CODES = ["high_value", "loyal", "price_hunter", "at_risk"]


def segmented(spark: SparkSession, folder: str) -> DataFrame:
    """Scored customers with the fixed segment of their cluster."""
    names = dict(enumerate(CLUSTER_CODES))
    return proxies.scored_customers(spark, folder).withColumn("segment", X.rename_values(F.col("cluster"), names))


def _facts_and_segments(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored customers, and their segments as a table of its own."""
    base = stored(segmented(spark, folder), "segmented")
    return base, base.select("customer_id", "account_age_months", F.col("segment").alias("segment_name"))


PSEG = PS + f""",
seg AS (SELECT *, {SEGMENT_CASE} AS segment FROM ps)"""


@query(
    "training_table",
    with_views(
        f"""SELECT customer_id, {", ".join(c for c in W.CUSTOMER_MEASURES if c != "discount_usage_rate")}, churned,
                   CASE loyalty_status WHEN 'Yes' THEN 1 ELSE 0 END AS loyalty_member,
                   CASE WHEN account_age_months > 60 THEN segment END AS segment_name
            FROM seg""",
        PSEG,
    ),
)
def training_table(spark, folder):
    """Segments come from a run that knew accounts older than 60 months; the others have none."""
    base, segments = _facts_and_segments(spark, folder)
    segments = segments.where("account_age_months > 60")
    loyalty = W.loyalty_dimension(spark)
    return W.training_table(W.customer_facts(base, loyalty), loyalty, segments)


@query(
    "master_cross",
    with_views(
        """SELECT customer_id, segment AS segment_name, risk_tier, churn_score, churn_predicted, avg_order_value,
                  total_orders, days_since_last_purchase, engagement_score, satisfaction_score,
                  customer_support_tickets, churned, loyalty_status
           FROM seg""",
        PSEG,
    ),
)
def master_cross(spark, folder):
    base, segments = _facts_and_segments(spark, folder)
    loyalty = W.loyalty_dimension(spark)
    scores = base.select("customer_id", "churn_score", "churn_predicted", "risk_tier")
    return W.master_table(W.customer_facts(base, loyalty), loyalty, segments, scores)
