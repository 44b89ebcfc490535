"""Scaling, clustering, segment naming and profiles."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tallyhouse.config import stored
from tallyhouse.functions import expressions as X
from tallyhouse.labels import SEGMENT_FEATURES, SEGMENT_NAMES, SEGMENT_ORDER
from tallyhouse.operators import reshape as R, segments as G, silhouettes
from tallyhouse.plans.load_queries import PSEG, customer_table, scored_table, segmented
from tallyhouse.plans.registry import query, rounded
from tallyhouse.sources import proxies
from tallyhouse.sources.proxy_sql import PC, PS, with_views

Z_SQL = ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER () AS {c}" for c in SEGMENT_FEATURES
)


@query(
    "zscore",
    with_views(
        "SELECT customer_id, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in SEGMENT_FEATURES)
        + f" FROM (SELECT customer_id, {Z_SQL} FROM pc)",
        PC,
    ),
)
def zscore(spark, folder):
    frame = customer_table(spark, folder, "customer_id", *SEGMENT_FEATURES)
    return rounded(G.apply_scaling(frame, G.fit_scaling(frame, SEGMENT_FEATURES)))


@query("kmeans_assign")
def kmeans_assign(spark, folder):
    """Cluster of every customer; the lowest-cost fit of ten seeds."""
    customers = customer_table(spark, folder, "customer_id", *SEGMENT_FEATURES)
    return G.assign_clusters(customers, k=4, restarts=10).select("customer_id", "cluster")


@query(
    "kmeans_check",
    with_views(
        "SELECT count(*) AS customers, CAST(0 AS BIGINT) AS empty_clusters, CAST(0 AS BIGINT) AS misplaced FROM pc", PC
    ),
)
def kmeans_check(spark, folder):
    """Customers in clusters, empty clusters, and customers clearly nearer to the mean of another cluster."""
    customers = customer_table(spark, folder, "customer_id", *SEGMENT_FEATURES)
    assigned = stored(G.assign_clusters(customers, k=4), "assigned")
    scaled = G.apply_scaling(assigned, G.fit_scaling(assigned, SEGMENT_FEATURES, filled=True)).fillna(0.0, SEGMENT_FEATURES)
    means = scaled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in SEGMENT_FEATURES]).collect()  # four rows
    distance = {m["cluster"]: sum((F.col(c) - F.lit(m[c])) ** 2 for c in SEGMENT_FEATURES) for m in means}
    own = F.coalesce(*[F.when(F.col("cluster") == k, d) for k, d in distance.items()])
    return scaled.agg(
        F.count(F.lit(1)).alias("customers"),
        F.lit(4 - len(means)).cast("bigint").alias("empty_clusters"),
        F.count_if(own > 1.01 * F.least(*distance.values())).alias("misplaced"),
    )


@query(
    "k_sweep_check",
    with_views(
        f"""SELECT 7 AS ks, 1 AS best, 0 AS rising, 0 AS above_total,
                   round(count(*) * CAST({len(SEGMENT_FEATURES)} AS DOUBLE), 3) AS total_squares FROM pc""",
        PC,
    ),
)
def k_sweep_check(spark, folder):
    """The sweep has one best k, and its inertia falls with k from at most the total sum of squares."""
    customers = customer_table(spark, folder, *SEGMENT_FEATURES)
    scaling = G.fit_scaling(customers, SEGMENT_FEATURES, filled=True)
    swept = G.sweep_k(G.to_vectors(customers, SEGMENT_FEATURES, scaling).select("features"), 2, 8)
    norm = sum(F.col(c) * F.col(c) for c in SEGMENT_FEATURES)
    total = G.apply_scaling(customers, scaling).fillna(0.0, SEGMENT_FEATURES).agg(F.sum(norm)).first()[0]
    before = F.lag("inertia").over(Window.orderBy("k"))  # seven rows
    return swept.withColumn("before", before).agg(
        F.count(F.lit(1)).cast("int").alias("ks"),
        F.sum("best").cast("int").alias("best"),
        F.count_if(F.col("inertia") > 1.01 * F.col("before")).cast("int").alias("rising"),
        F.count_if(F.col("inertia") > F.lit(total)).cast("int").alias("above_total"),
        F.round(F.lit(total), 3).alias("total_squares"),
    )


@query("k_sweep")
def k_sweep(spark, folder):
    """Inertia and silhouette for k = 2..8, the best of ten seeds each."""
    customers = customer_table(spark, folder, *SEGMENT_FEATURES)
    scaling = G.fit_scaling(customers, SEGMENT_FEATURES, filled=True)
    vectors = G.to_vectors(customers, SEGMENT_FEATURES, scaling).select("features")
    return rounded(G.sweep_k(vectors, 2, 8))


def _squares(names: list[str], left: str = "", right: str = "") -> str:
    return " + ".join(f"{left}{c} * {right}{c}" for c in names)


_SIL_TOTAL = f"({_squares(SEGMENT_FEATURES, 'z.', 'z.')}) * n - 2 * ({' + '.join(f'z.{c} * s_{c}' for c in SEGMENT_FEATURES)}) + squares"


@query(
    "silhouette_sq",
    with_views(
        f"""SELECT cluster, count(*) AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM (
              SELECT customer_id, z.cluster AS cluster,
                     max(CASE WHEN z.cluster = t.cluster THEN ({_SIL_TOTAL}) / (n - 1) END) AS a,
                     min(CASE WHEN z.cluster <> t.cluster THEN ({_SIL_TOTAL}) / n END) AS b
              FROM z, t GROUP BY customer_id, z.cluster) GROUP BY cluster""",
        PS,
        f"z AS MATERIALIZED (SELECT customer_id, cluster, {Z_SQL} FROM ps)",
        f"""t AS MATERIALIZED (SELECT cluster, count(*) AS n, sum({_squares(SEGMENT_FEATURES)}) AS squares,
             {", ".join(f"sum({c}) AS s_{c}" for c in SEGMENT_FEATURES)} FROM z GROUP BY cluster)""",
    ),
)
def silhouette_sq(spark, folder):
    """Squared-Euclidean silhouette of the fixed clusters, over all customers."""
    frame = scored_table(spark, folder, "customer_id", "cluster", *SEGMENT_FEATURES)
    scaled = G.apply_scaling(frame, G.fit_scaling(frame, SEGMENT_FEATURES))
    return rounded(G.silhouette(scaled, SEGMENT_FEATURES, "cluster"))


def _euclid_sql(anchors: int) -> list[str]:
    """Anchors of each cluster by hash, and their mean distances to every cluster."""
    return [
        f"z AS MATERIALIZED (SELECT customer_id, cluster, {Z_SQL} FROM ps)",
        f"""drawn AS MATERIALIZED (SELECT * FROM z QUALIFY row_number() OVER (
             PARTITION BY cluster ORDER BY CAST('0x' || substr(md5(customer_id || ':42'), 1, 13) AS BIGINT), customer_id)
             <= greatest(1, {anchors} // (SELECT count(DISTINCT cluster) FROM z)))""",
        f"""far AS MATERIALIZED (SELECT a.customer_id, a.cluster AS own, b.cluster AS other, count(*) AS n,
             sum(sqrt({" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SEGMENT_FEATURES)})) AS far
             FROM drawn a, z b GROUP BY ALL)""",
        """each AS (SELECT customer_id, own, max(CASE WHEN own = other THEN far / (n - 1) END) AS a,
             min(CASE WHEN own <> other THEN far / n END) AS b FROM far GROUP BY ALL)""",
    ]


@query(
    "silhouette_exact",
    with_views(
        """SELECT own AS cluster, count(*) AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM each GROUP BY own""",
        PS,
        *_euclid_sql(200),
    ),
)
def silhouette_exact(spark, folder):
    """Euclidean silhouette of 200 anchors of the fixed clusters against all customers."""
    frame = scored_table(spark, folder, "customer_id", "cluster", *SEGMENT_FEATURES)
    scaled = G.apply_scaling(frame, G.fit_scaling(frame, SEGMENT_FEATURES))
    return rounded(silhouettes.silhouette_exact(scaled, SEGMENT_FEATURES, "cluster", "customer_id", 200))


def _axis_sql(cov: str, n: int) -> list[str]:
    """CTEs for the leading eigenpair of a covariance table: the matrix squared eleven times, then its column."""
    steps = [f"{cov}_0 AS (SELECT * FROM {cov})"]
    for s in range(11):
        p = f"{cov}_{s}"
        steps.append(
            f"""{cov}_{s + 1} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) / (SELECT sum(v * v) FROM {p}) AS v
                FROM {p} a JOIN {p} b ON a.j = b.i GROUP BY ALL)"""
        )
    last = f"{cov}_11"
    return [
        *steps,
        f"w{n}_raw AS MATERIALIZED (SELECT i, v FROM {last} WHERE j = (SELECT j FROM {last} WHERE i = j ORDER BY v DESC LIMIT 1))",
        f"""w{n} AS MATERIALIZED (SELECT i, v / (SELECT sqrt(sum(v * v)) FROM w{n}_raw)
            * (SELECT sign(v) FROM w{n}_raw WHERE abs(v) >= (SELECT max(abs(v)) FROM w{n}_raw) * (1 - 1e-6) ORDER BY i LIMIT 1) AS v FROM w{n}_raw)""",
        f"lambda{n} AS MATERIALIZED (SELECT sum(a.v * c.v * b.v) AS v FROM {cov} c JOIN w{n} a ON a.i = c.i JOIN w{n} b ON b.i = c.j)",
    ]


PCA_SQL = [
    f"z AS MATERIALIZED (SELECT customer_id, {Z_SQL} FROM pc)",
    f"""l AS MATERIALIZED (SELECT customer_id, unnest(range({len(SEGMENT_FEATURES)})) AS i,
        unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in SEGMENT_FEATURES)}]) AS v FROM z)""",
    "ca AS MATERIALIZED (SELECT a.i, b.i AS j, avg(a.v * b.v) AS v FROM l a JOIN l b USING (customer_id) GROUP BY ALL)",
    *_axis_sql("ca", 1),
    """cb AS MATERIALIZED (SELECT c.i, c.j, c.v - (SELECT v FROM lambda1) * a.v * b.v AS v
       FROM ca c JOIN w1 a ON a.i = c.i JOIN w1 b ON b.i = c.j)""",
    *_axis_sql("cb", 2),
]


@query(
    "pca_2d",
    with_views(
        """SELECT customer_id, round(sum(l.v * w1.v), 6) AS pca_1, round(sum(l.v * w2.v), 6) AS pca_2,
                  round((SELECT v FROM lambda1) / (SELECT sum(v) FROM ca WHERE i = j), 6) AS explained_1,
                  round((SELECT v FROM lambda2) / (SELECT sum(v) FROM ca WHERE i = j), 6) AS explained_2
           FROM l JOIN w1 USING (i) JOIN w2 USING (i) GROUP BY customer_id""",
        PC,
        *PCA_SQL,
    ),
)
def pca_2d(spark, folder):
    customers = customer_table(spark, folder, "customer_id", *SEGMENT_FEATURES)
    return rounded(G.principal_axes(customers, "customer_id", SEGMENT_FEATURES), 6)


NAMING_SQL = """means AS (
  SELECT cluster, avg(days_since_last_purchase) AS days, avg(churned) AS churn, avg(avg_order_value) AS value,
         avg(engagement_score) AS engagement FROM ps GROUP BY cluster),
risky AS (
  SELECT cluster FROM (
    SELECT cluster, rank() OVER (ORDER BY days) + (count(*) OVER (PARTITION BY days) - 1) / 2.0
                    + rank() OVER (ORDER BY churn) + (count(*) OVER (PARTITION BY churn) - 1) / 2.0 AS risk FROM means)
  ORDER BY risk DESC, cluster LIMIT 1),
premium AS (
  SELECT cluster FROM means WHERE cluster NOT IN (FROM risky) ORDER BY value DESC, cluster LIMIT 1),
loyals AS (
  SELECT cluster FROM means WHERE cluster NOT IN (FROM risky) AND cluster NOT IN (FROM premium)
  ORDER BY engagement DESC, cluster LIMIT 1),
names AS (
  SELECT cluster, CASE WHEN cluster IN (FROM risky) THEN 'at_risk' WHEN cluster IN (FROM premium) THEN 'high_value'
                       WHEN cluster IN (FROM loyals) THEN 'loyal' ELSE 'price_hunter' END AS segment FROM means)"""


@query("segment_naming", with_views("SELECT cluster, segment FROM names", PS, NAMING_SQL))
def segment_naming(spark, folder):
    return G.name_segments(G.cluster_means(proxies.scored_customers(spark, folder)))


@query(
    "cluster_sizes",
    with_views(
        """SELECT cluster, count(*) AS count, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 6) AS pct
           FROM ps GROUP BY cluster ORDER BY cluster""",
        PS,
    ),
)
def cluster_sizes(spark, folder):
    return rounded(R.group_share(proxies.scored_customers(spark, folder), "cluster")).orderBy("cluster")


def _name_case(column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in SEGMENT_NAMES.items()) + " END"


@query(
    "segment_profile",
    with_views(
        f"""SELECT segment, {_name_case("segment")} AS segment_name, count(customer_id) AS customers,
                   round(avg(churned) * 100, 6) AS pct_churned,
                   round(avg(CASE WHEN loyalty_status = 'Yes' THEN 1 ELSE 0 END) * 100, 6) AS pct_loyalty,
                   {", ".join(f"round(avg({c}), 6) AS {c}" for c in SEGMENT_FEATURES)},
                   round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 6) AS pct_of_all
            FROM ps JOIN names USING (cluster) GROUP BY segment""",
        PS,
        NAMING_SQL,
    ),
)
def segment_profile(spark, folder):
    """Clusters named from their own means, then profiled."""
    scored = scored_table(spark, folder)
    names = {r["cluster"]: r["segment"] for r in G.name_segments(G.cluster_means(scored)).collect()}
    profiled = G.segment_profile(scored.withColumn("segment", X.rename_values(F.col("cluster"), names)))
    return rounded(profiled.withColumn("segment_name", X.rename_values(F.col("segment"), SEGMENT_NAMES)))


@query(
    "profile_minmax",
    with_views(
        "SELECT segment, "
        + ", ".join(
            f"round((avg({c}) - min(avg({c})) OVER ()) / (max(avg({c})) OVER () - min(avg({c})) OVER ()), 6) AS {c}"
            for c in SEGMENT_FEATURES
        )
        + " FROM seg GROUP BY segment",
        PSEG,
    ),
)
def profile_minmax(spark, folder):
    means = segmented(spark, folder).groupBy("segment").agg(*[F.avg(c).alias(c) for c in SEGMENT_FEATURES])
    return rounded(R.minmax_scale(means, SEGMENT_FEATURES))


@query(
    "segment_rates",
    with_views(
        f"""SELECT CAST(list_position({SEGMENT_ORDER}, segment) - 1 AS INTEGER) AS position, segment,
                   round(avg(churned) * 100, 6) AS churn_pct,
                   round(avg(CASE WHEN loyalty_status = 'Yes' THEN 1 ELSE 0 END) * 100, 6) AS loyalty_pct
            FROM seg GROUP BY segment""",
        PSEG,
    ),
)
def segment_rates(spark, folder):
    rates = segmented(spark, folder).groupBy("segment").agg(
        (X.rate(F.col("churned") == 1) * 100).alias("churn_pct"),
        (X.rate(F.col("loyalty_status") == "Yes") * 100).alias("loyalty_pct"),
    )
    return rounded(R.reindex(rates, "segment", SEGMENT_ORDER)).select("position", "segment", "churn_pct", "loyalty_pct")
