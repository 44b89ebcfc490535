"""The same customer and order views as SQL text, for the independent checks."""

PC = """pc_orders AS (
  SELECT o_custkey,
         min(CASE WHEN CAST(o_orderdate AS DATE) < DATE '2000-08-01' THEN CAST(o_orderdate AS DATE) END) AS first_day,
         max(CASE WHEN CAST(o_orderdate AS DATE) < DATE '2000-08-01' THEN CAST(o_orderdate AS DATE) END) AS last_day,
         sum(CASE WHEN CAST(o_orderdate AS DATE) < DATE '2000-08-01' THEN 1 ELSE 0 END) AS n_before,
         sum(CASE WHEN CAST(o_orderdate AS DATE) < DATE '2000-08-01' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS value_cents,
         sum(CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2000-08-01' THEN 1 ELSE 0 END) AS n_after
  FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-01'
  GROUP BY o_custkey),
pc_lines AS (
  SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n_lines,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / 100 AS discounts,
         CAST(sum(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS DOUBLE) AS n_discounted,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS n_returned,
         CAST(sum(CAST(round(l_quantity * 100) AS BIGINT)) AS DOUBLE) / 100 AS quantities
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE CAST(o_orderdate AS DATE) < DATE '2000-08-01'
  GROUP BY o_custkey),
pc_events AS (
  SELECT user_id, count(*) AS n_events,
         sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS n_view,
         sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS n_click,
         sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS n_purchase,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n_error
  FROM events GROUP BY user_id),
pc AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         CASE WHEN c_acctbal >= 5000 THEN 'Yes' ELSE 'No' END AS loyalty_status,
         CAST((2000 - year(first_day)) * 12 + 8 - month(first_day) AS INTEGER) AS account_age_months,
         CAST(n_before AS INTEGER) AS total_orders,
         CAST(DATE '2000-08-01' - last_day AS INTEGER) AS days_since_last_purchase,
         CAST(value_cents AS DOUBLE) / 100 / CAST(n_before AS DOUBLE) AS avg_order_value,
         discounts / n_lines * 10 AS price_sensitivity_index,
         CAST(coalesce(n_view, 0) * 7 AS DOUBLE) / 30 AS browsing_frequency_per_week,
         CASE WHEN n_click + n_purchase > 0 THEN CAST(n_click AS DOUBLE) / CAST(n_click + n_purchase AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS cart_abandonment_rate,
         n_discounted / n_lines AS discount_usage_rate,
         n_returned / n_lines AS return_rate,
         CAST(coalesce(n_error, 0) AS INTEGER) AS customer_support_tickets,
         quantities / n_lines / 10 AS product_review_score_avg,
         least(CAST(10 AS DOUBLE), CAST(coalesce(n_events, 0) AS DOUBLE) / 10) AS engagement_score,
         CAST(10 AS DOUBLE) * (CAST(1 AS DOUBLE) - n_returned / n_lines) AS satisfaction_score,
         CASE WHEN n_after = 0 THEN 1 ELSE 0 END AS churned
  FROM pc_orders o JOIN customer ON c_custkey = o.o_custkey
  LEFT JOIN pc_lines l ON l.o_custkey = c_custkey
  LEFT JOIN pc_events ON user_id = c_custkey // 10
  WHERE n_before > 0)"""

PO = """po AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, CAST(o_orderdate AS DATE) AS order_date,
         p_type AS product_category, o_orderpriority AS payment_method, o_orderstatus AS order_status,
         p_size AS customer_age, l_extendedprice AS order_value,
         CAST(abs(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)) AS INTEGER) AS delivery_time_days,
         l_quantity / CAST(10 AS DOUBLE) AS customer_rating,
         CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS discount_applied
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey)"""

PS = (
    PC
    + """,
ps_raw AS (
  SELECT *, CAST(CAST(customer_id AS BIGINT) % 4 AS INTEGER) AS cluster,
         1 / (1 + exp(-(CAST(0.01 AS DOUBLE) * (days_since_last_purchase - 240)
                        - CAST(0.3 AS DOUBLE) * (engagement_score - 6)))) AS raw_score
  FROM pc),
ps AS (
  SELECT * EXCLUDE (raw_score), round(raw_score, 6) AS churn_score,
         CASE WHEN raw_score > 0.5 THEN 1 ELSE 0 END AS churn_predicted,
         CASE WHEN raw_score <= 0 THEN NULL WHEN raw_score <= 0.25 THEN 'low' WHEN raw_score <= 0.5 THEN 'medium'
              WHEN raw_score <= 0.75 THEN 'high' WHEN raw_score <= 1.01 THEN 'critical' END AS risk_tier
  FROM ps_raw)"""
)


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + body
