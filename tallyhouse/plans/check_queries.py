"""Data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators import quality as Q
from tallyhouse.plans.registry import query
from tallyhouse.sources import proxies
from tallyhouse.sources.proxy_sql import PC, PO, with_views
from tallyhouse.sources.tables import table

EXPECTED = {"region": 5, "nation": 25, "supplier": 100, "customer": None, "orders": None, "lineitem": None}


def _counts(spark, folder):
    return Q.row_counts({name: table(spark, folder, name) for name in EXPECTED}, EXPECTED)


_COUNTS_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", CAST({"NULL" if n is None else n} AS BIGINT) AS expected, count(*) AS rows,
        CASE WHEN {"NULL" if n is None else n} IS NULL THEN 'info' WHEN count(*) = {n or 0} THEN 'ok' ELSE 'fail' END
        AS status FROM {name}"""
    for name, n in EXPECTED.items()
)


@query("dq_row_counts", _COUNTS_SQL)
def dq_row_counts(spark, folder):
    return _counts(spark, folder)


# relation, fact table, foreign key, referenced table, key
RELATIONS = [
    ("orders → customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem → orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem → part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem → supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer → nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation → region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("events → supplier", "events", "user_id", "supplier", "s_suppkey"),
]


def _orphans(spark, folder):
    return Q.orphans(
        [
            (name, table(spark, folder, fact), fk, table(spark, folder, dim), pk)
            for name, fact, fk, dim, pk in RELATIONS
        ]
    )


_ORPHANS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS relation, count(*) AS broken FROM {fact} LEFT JOIN {dim} ON {fk} = {pk} WHERE {pk} IS NULL"
    for name, fact, fk, dim, pk in RELATIONS
)


@query("dq_orphans", _ORPHANS_SQL)
def dq_orphans(spark, folder):
    return _orphans(spark, folder)


NOT_NULL = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
}


@query(
    "dq_not_null",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{c}' AS "column", count(*) - count({c}) AS nulls FROM {name}"""
        for name, columns in NOT_NULL.items()
        for c in columns
    ),
)
def dq_not_null(spark, folder):
    frames = [Q.nulls(table(spark, folder, name), name, columns) for name, columns in NOT_NULL.items()]
    return reduce(DataFrame.unionByName, frames)


KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "events": ["event_id"],
}


def _duplicates(spark, folder):
    frames = [Q.duplicates(table(spark, folder, name), name, key) for name, key in KEYS.items()]
    return reduce(DataFrame.unionByName, frames)


@query(
    "dq_unique",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{",".join(key)}' AS key, count(*) AS duplicate_keys,
            CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows
            FROM (SELECT count(*) AS n FROM {name} GROUP BY {",".join(key)} HAVING count(*) > 1)"""
        for name, key in KEYS.items()
    ),
)
def dq_unique(spark, folder):
    return _duplicates(spark, folder)


LINE_RULES = {
    "discount_flag": "discount_applied IN (0, 1)",
    "rating_range": "customer_rating BETWEEN 0 AND 4.5",
    "known_status": "order_status IN ('F', 'O')",
}
CUSTOMER_RULES = {"churned_flag": "churned IN (0, 1)", "tenure_range": "account_age_months BETWEEN 0 AND 60"}


def _domain(spark, folder):
    lines = proxies.order_lines(spark, folder, "discount_applied", "customer_rating", "order_status")
    return Q.domain_violations(lines, "order_lines", LINE_RULES).unionByName(
        Q.domain_violations(proxies.customers(spark, folder), "customers", CUSTOMER_RULES)
    )


@query(
    "dq_domain",
    with_views(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS "table", '{label}' AS rule, count(*) FILTER (WHERE NOT ({rule})) AS violations
                FROM {view}"""
            for name, view, rules in (("order_lines", "po", LINE_RULES), ("customers", "pc", CUSTOMER_RULES))
            for label, rule in rules.items()
        ),
        PC,
        PO,
    ),
)
def dq_domain(spark, folder):
    return _domain(spark, folder)


@query(
    "dq_load_summary",
    with_views(
        """SELECT 'customers' AS "check", count(*) AS value FROM pc
           UNION ALL SELECT 'churned', count(*) FROM pc WHERE churned = 1
           UNION ALL SELECT 'active', count(*) FROM pc WHERE churned = 0
           UNION ALL SELECT 'loyalty_broken', count(*) FROM pc WHERE loyalty_status NOT IN ('Yes', 'No')
           UNION ALL SELECT 'orders', count(*) FROM po
           UNION ALL SELECT 'dates', count(DISTINCT order_date) FROM po
           UNION ALL SELECT 'categories', count(DISTINCT product_category) FROM po
           UNION ALL SELECT 'methods', count(DISTINCT payment_method) FROM po
           UNION ALL SELECT 'statuses', count(DISTINCT order_status) FROM po
           UNION ALL SELECT 'date_broken', count(*) FROM po WHERE order_date IS NULL""",
        PC,
        PO,
    ),
)
def dq_load_summary(spark, folder):
    customers = proxies.customers(spark, folder).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("churned") == 1).alias("churned"),
        F.count_if(F.col("churned") == 0).alias("active"),
        F.count_if(~F.col("loyalty_status").isin("Yes", "No")).alias("loyalty_broken"),
    )
    kinds = proxies.order_lines(
        spark, folder, "order_date", "product_category", "payment_method", "order_status"
    )
    # A group per combination first: the distinct counts then read few rows.
    combined = kinds.groupBy(*kinds.columns).agg(F.count(F.lit(1)).alias("n"))
    orders = combined.agg(
        F.sum("n").alias("orders"),
        F.countDistinct("product_category").alias("categories"),
        F.countDistinct("payment_method").alias("methods"),
        F.countDistinct("order_status").alias("statuses"),
        F.countDistinct("order_date").alias("dates"),
        F.coalesce(F.sum(F.when(F.col("order_date").isNull(), F.col("n"))), F.lit(0)).alias("date_broken"),
    )
    melted = [df.unpivot([], df.columns, "check", "value") for df in (customers, orders)]
    return melted[0].unionByName(melted[1])


@query(
    "dq_verdict",
    f"""WITH checks AS (
          SELECT status <> 'fail' AS passed FROM ({_COUNTS_SQL})
          UNION ALL SELECT broken = 0 FROM ({_ORPHANS_SQL})
          UNION ALL SELECT count(*) = 0 FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
          UNION ALL SELECT count(*) = 0 FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
          UNION ALL SELECT count(*) = 0 FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)
          UNION ALL SELECT count(*) = 0 FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1))
        SELECT count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed, bool_and(passed) AS all_ok FROM checks""",
)
def dq_verdict(spark, folder):
    return Q.verdict(
        [
            _counts(spark, folder).select((F.col("status") != "fail").alias("passed")),
            _orphans(spark, folder).select((F.col("broken") == 0).alias("passed")),
            _duplicates(spark, folder).select((F.col("duplicate_keys") == 0).alias("passed")),
        ]
    )


@query(
    "preview_topn",
    with_views("SELECT * FROM pc ORDER BY customer_id LIMIT 3", PC),
)
def preview_topn(spark, folder):
    return proxies.customers(spark, folder).orderBy("customer_id").limit(3)
