"""Split, balancing, classifiers, metrics and scores."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tallyhouse.config import stored
from tallyhouse.functions import expressions as X
from tallyhouse.labels import CHURN_FEATURES
from tallyhouse.operators import classify as C, evaluate as E, neighbors as N, newton as W, sampling
from tallyhouse.plans.load_queries import customer_table, scored_table
from tallyhouse.plans.registry import query, rounded
from tallyhouse.sources import proxies
from tallyhouse.sources.proxy_sql import PC, PS, with_views

OUTCOME = ["churned", "churn_predicted", "churn_score"]


def _labelled(spark, folder):
    """Customers with loyalty as 1/0, stored: the balancing and the fits pass over them often."""
    member = X.flag_from_text(F.col("loyalty_status"))
    customers = proxies.customers(spark, folder).withColumn("loyalty_member", member)
    return stored(customers.select("customer_id", *CHURN_FEATURES, "churned"))


SPLIT_SQL = """split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY substr(md5(customer_id || ':42'), 1, 13))
                      <= floor(CAST(0.8 AS DOUBLE) * count(*) OVER (PARTITION BY churned) + 0.5)
                 THEN 'train' ELSE 'test' END AS split FROM pc)"""


@query("stratified_split", with_views("SELECT customer_id, churned, split FROM split", PC, SPLIT_SQL))
def stratified_split(spark, folder):
    rows = customer_table(spark, folder, "customer_id", "churned")
    return sampling.stratified_split(rows, "churned", "customer_id", 0.8, 42)


@query(
    "class_balance",
    with_views(
        """SELECT split, churned, count(*) AS count,
                  round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY split), 6) AS pct
           FROM split GROUP BY split, churned""",
        PC,
        SPLIT_SQL,
    ),
)
def class_balance(spark, folder):
    """Class sizes of the train and test rows."""
    rows = customer_table(spark, folder, "customer_id", "churned")
    split = sampling.stratified_split(rows, "churned", "customer_id", 0.8, 42)
    counted = split.groupBy("split", "churned").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy("split"))
    return rounded(counted.withColumn("pct", X.percent(F.col("count"), total)))


_KNN_X = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in CHURN_FEATURES if c != "loyalty_member") + "]"


@query(
    "knn_minority",
    with_views(
        """SELECT id, neighbor, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM (
             SELECT a.customer_id AS id, b.customer_id AS neighbor, list_distance(a.x, b.x) AS distance,
                    row_number() OVER (PARTITION BY a.customer_id ORDER BY list_distance(a.x, b.x), b.customer_id) AS rank
             FROM m a JOIN m b ON a.customer_id <> b.customer_id) WHERE rank <= 5""",
        PC,
        f"m AS MATERIALIZED (SELECT customer_id, {_KNN_X} AS x FROM pc WHERE churned = 1)",
    ),
)
def knn_minority(spark, folder):
    """The five nearest churned customers of each churned customer."""
    features = [c for c in CHURN_FEATURES if c != "loyalty_member"]
    rare = customer_table(spark, folder, "customer_id", "churned", *features).where("churned = 1")
    near = N.nearest_neighbors(rare, "customer_id", features, 5)
    return near.select("id", "neighbor", "rank", F.round("distance", 6).alias("distance"))


WHOLE = [
    "account_age_months",
    "total_orders",
    "days_since_last_purchase",
    "customer_support_tickets",
    "loyalty_member",
]


def _between_sql(c: str) -> str:
    value = f"a.{c} + step * (b.{c} - a.{c})"
    return f"CAST(trunc({value}) AS INTEGER) AS {c}" if c in WHOLE else f"{value} AS {c}"


def _hash_sql(text: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5({text} || ':{seed}'), 1, 13) AS BIGINT)"


_X_SQL = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in CHURN_FEATURES) + "]"


@query(
    "smote_balance",
    with_views(
        f"""SELECT customer_id, {", ".join(CHURN_FEATURES)}, churned,
                   0 AS synthetic FROM train
            UNION ALL
            SELECT token, {", ".join(_between_sql(c) for c in CHURN_FEATURES)}, 1, 1
            FROM drawn JOIN near ON near.id = base AND near.rank = choice
            JOIN train a ON a.customer_id = base JOIN train b ON b.customer_id = near.neighbor""",
        PC,
        SPLIT_SQL,
        """train AS MATERIALIZED (SELECT *, CASE WHEN loyalty_status = 'Yes' THEN 1 ELSE 0 END AS loyalty_member
                                  FROM split WHERE split = 'train')""",
        f"m AS MATERIALIZED (SELECT customer_id, {_X_SQL} AS x FROM train WHERE churned = 1)",
        """near AS (SELECT * FROM (
             SELECT a.customer_id AS id, b.customer_id AS neighbor,
                    row_number() OVER (PARTITION BY a.customer_id ORDER BY list_distance(a.x, b.x), b.customer_id) AS rank
             FROM m a JOIN m b ON a.customer_id <> b.customer_id) WHERE rank <= 5)""",
        """sizes AS (SELECT count(*) FILTER (WHERE churned = 1) AS rare,
                            count(*) FILTER (WHERE churned = 0) - count(*) FILTER (WHERE churned = 1) AS deficit FROM train)""",
        f"""bases AS (SELECT customer_id AS base, row_number() OVER (ORDER BY {_hash_sql("customer_id", 42)}, customer_id) AS place
                      FROM m)""",
        f"""drawn AS (
              SELECT base, token, {_hash_sql("token", 43)} % (SELECT least(5, rare - 1) FROM sizes) + 1 AS choice,
                     {_hash_sql("token", 44)} / CAST(4503599627370496 AS DOUBLE) AS step
              FROM (SELECT base, base || '#' || unnest(range(1, 1 + CAST(deficit // rare + CASE WHEN place <= deficit % rare
                                                                         THEN 1 ELSE 0 END AS BIGINT))) AS token
                    FROM bases, sizes))""",
    ),
)
def smote_balance(spark, folder):
    """Train rows with the minority class raised to the size of the majority."""
    split = sampling.stratified_split(_labelled(spark, folder), "churned", "customer_id", 0.8, 42)
    train = split.where("split = 'train'")
    return N.oversample_minority(train, "churned", "customer_id", CHURN_FEATURES)


@query("lr_score")
def lr_score(spark, folder):
    """Logistic regression on balanced train rows; scores for every customer."""
    rows, balanced = C.training_rows(_labelled(spark, folder))
    return C.score_customers(C.fit_logistic(balanced), rows)


@query(
    "lr_check",
    with_views(
        """SELECT 1 AS flat, 2 * count(*) FILTER (WHERE churned = 0) AS rows_fitted,
                  count(*) FILTER (WHERE churned = 0) AS positives FROM split WHERE split = 'train'""",
        PC,
        SPLIT_SQL,
    ),
)
def lr_check(spark, folder):
    """The gradient of C * loss + |w|^2 / 2 vanishes at the fitted weights; both classes weigh the same."""
    _, balanced = C.training_rows(_labelled(spark, folder))
    fitted = C.fit_logistic(balanced)
    miss = F.col("raw_score") - F.col("churned")
    columns = {c: F.coalesce((F.col(c).cast("double") - F.lit(m)) / F.lit(s), F.lit(0.0)) for c, (m, s) in fitted.scaling.items()}
    sums = fitted.score(balanced).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("churned").cast("bigint")).alias("ones"),
        F.sum(miss).alias("bias"),
        *[F.sum(miss * x).alias(c) for c, x in columns.items()],
    ).first()
    weights = dict(zip(fitted.features, fitted.model.coefficients.toArray(), strict=True))
    steepest = max([abs(sums["bias"]), *[abs(sums[c] + weights[c]) for c in columns]])
    flat = int(steepest / sums["n"] < 1e-4)
    return spark.range(1).select(
        F.lit(flat).alias("flat"), F.lit(sums["n"]).cast("bigint").alias("rows_fitted"), F.lit(sums["ones"]).cast("bigint").alias("positives")
    )


@query(
    "gbt_check",
    with_views(
        f"""SELECT count(*) AS customers, {len(CHURN_FEATURES)} AS features, 300 AS rounds, CAST(1.0 AS DOUBLE) AS importance,
                   CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS wrong_tier FROM pc""",
        PC,
    ),
)
def gbt_check(spark, folder):
    """Rounds, importances and scores of the boosted trees are consistent."""
    rows, balanced = C.training_rows(_labelled(spark, folder))
    fitted = C.fit_boosted(balanced)
    weights = [r.importance for r in C.importances(fitted, spark).collect()]  # a row per feature
    score = F.col("churn_score")
    tier = F.when(score <= 0.25, "low").when(score <= 0.5, "medium").when(score <= 0.75, "high").otherwise("critical")
    near_edge = F.pmod(score + 1e-6, F.lit(0.25)) < 2e-6  # rounding may cross an edge
    return C.score_customers(fitted, rows).agg(
        F.count(F.lit(1)).alias("customers"),
        F.lit(len(weights)).alias("features"),
        F.lit(fitted.model.getNumTrees).alias("rounds"),
        F.lit(round(sum(weights), 6)).alias("importance"),
        F.count_if(~score.between(0.0, 1.0)).alias("out_of_range"),
        F.count_if((F.col("risk_tier") != tier) & ~near_edge).alias("wrong_tier"),
    )


@query("gbt_score")
def gbt_score(spark, folder):
    """Boosted trees on balanced train rows; scores for every customer."""
    rows, balanced = C.training_rows(_labelled(spark, folder))
    return C.score_customers(C.fit_boosted(balanced), rows)


@query("feature_importance")
def feature_importance(spark, folder):
    """Importances of boosted trees and absolute coefficients of the regression."""
    _, balanced = C.training_rows(_labelled(spark, folder))
    trees = C.importances(C.fit_boosted(balanced), spark)
    lines = C.importances(C.fit_logistic(balanced), spark)
    both = trees.withColumn("model", F.lit("boosted")).unionByName(lines.withColumn("model", F.lit("logistic")))
    return rounded(both)


def _newton_sql(rounds: int, depth: int, step: float) -> list[str]:
    """The first trees of ``newton`` with all rows and columns, written from the formulas: a CTE per step."""
    names = ", ".join(f"CAST({c} AS DOUBLE)" for c in CHURN_FEATURES)
    out = [
        "member AS MATERIALIZED (SELECT *, CASE WHEN loyalty_status = 'Yes' THEN 1 ELSE 0 END AS loyalty_member FROM pc)",
        f"cells AS MATERIALIZED (SELECT customer_id, churned, unnest(range({len(CHURN_FEATURES)})) AS f, unnest([{names}]) AS v FROM member)",
        f"""edges AS MATERIALIZED (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS cut FROM (
              SELECT DISTINCT f, v FROM (
                SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS r, count(*) OVER (PARTITION BY f) AS n FROM cells WHERE v IS NOT NULL)
              JOIN range(1, {W.BINS}) i(i) ON r = CAST(ceil(i * n / CAST({W.BINS} AS DOUBLE)) AS BIGINT)))""",
        """bins AS MATERIALIZED (SELECT customer_id, c.f, count(cut) AS bin FROM cells c LEFT JOIN edges e ON e.f = c.f AND e.v < c.v GROUP BY ALL)""",
        "m0 AS MATERIALIZED (SELECT customer_id, churned, CAST(0 AS DOUBLE) AS m FROM pc)",
    ]
    for t in range(rounds):
        out.append(f"""g{t} AS MATERIALIZED (SELECT customer_id, 1 / (1 + exp(-m)) - churned AS g, 1 / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m))) AS h FROM m{t})""")
        out.append(f"a{t}_0 AS MATERIALIZED (SELECT customer_id, 1 AS node FROM m{t})")
        for d in range(depth):
            out.append(f"""t{t}_{d} AS MATERIALIZED (SELECT node, sum(g) AS g, sum(h) AS h FROM a{t}_{d} JOIN g{t} USING (customer_id) WHERE node >= {2**d} GROUP BY node)""")
            out.append(f"""c{t}_{d} AS MATERIALIZED (SELECT node, e.f, e.cut, e.v, sum(x.g) AS gl, sum(x.h) AS hl FROM edges e JOIN (
                  SELECT node, f, bin, sum(g) AS g, sum(h) AS h FROM a{t}_{d} JOIN g{t} USING (customer_id) JOIN bins USING (customer_id)
                  WHERE node >= {2**d} GROUP BY ALL) x ON x.f = e.f AND x.bin <= e.cut GROUP BY ALL)""")
            out.append(f"""s{t}_{d} AS MATERIALIZED (SELECT * FROM (
                  SELECT node, f, cut, v, 0.5::DOUBLE * (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) AS gain
                  FROM c{t}_{d} JOIN t{t}_{d} USING (node) WHERE hl >= 1 AND h - hl >= 1) WHERE gain > 1e-9
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 8) DESC, f, cut) = 1)""")
            out.append(f"""a{t}_{d + 1} AS MATERIALIZED (SELECT a.customer_id, CASE WHEN s.node IS NULL THEN a.node WHEN bin <= cut THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
                FROM a{t}_{d} a LEFT JOIN s{t}_{d} s ON s.node = a.node LEFT JOIN bins b ON b.customer_id = a.customer_id AND b.f = s.f)""")
        splits = " UNION ALL ".join(f"SELECT * FROM s{t}_{d}" for d in range(depth))
        out.append(f"""n{t} AS MATERIALIZED (SELECT node, sum(g) AS g, sum(h) AS h FROM (
              SELECT DISTINCT customer_id, node FROM ({" UNION ALL ".join(f"SELECT * FROM a{t}_{d}" for d in range(depth + 1))})) JOIN g{t} USING (customer_id) GROUP BY node)""")
        out.append(f"""tree{t} AS MATERIALIZED (SELECT {t} AS tree, n.node, f, v AS threshold, gain, h AS cover, CASE WHEN f IS NULL THEN -{step} * g / (h + 1) END AS value
              FROM n{t} n LEFT JOIN ({splits}) s ON s.node = n.node)""")
        out.append(f"""m{t + 1} AS MATERIALIZED (SELECT customer_id, churned, m + value AS m FROM m{t} JOIN a{t}_{depth} USING (customer_id) JOIN tree{t} USING (node))""")
    return [*out, "trees AS (" + " UNION ALL ".join(f"SELECT * FROM tree{t}" for t in range(rounds)) + ")"]


NAMED_SQL = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CHURN_FEATURES)) + " END"
FIRST_ROUNDS = W.Settings(rounds=2, rows=1.0, columns=1.0)


@query(
    "gbt_newton_rounds",
    with_views(
        f"""SELECT tree, CAST(node AS INTEGER) AS node, {NAMED_SQL} AS feature, round(threshold, 6) AS threshold, CAST(CASE WHEN f IS NOT NULL THEN 2 * node END AS INTEGER) AS left_node,
                   CAST(CASE WHEN f IS NOT NULL THEN 2 * node + 1 END AS INTEGER) AS right_node, round(coalesce(gain, 0), 6) AS gain, round(cover, 6) AS cover,
                   round(value, 6) + 0 AS value FROM trees""",
        PC,
        *_newton_sql(2, 4, 0.05),
    ),
)
def gbt_newton_rounds(spark, folder):
    """Node table of the first two trees of second order, fitted to all customers with draws off."""
    trees = W.fit_newton(_labelled(spark, folder), settings=FIRST_ROUNDS)
    table = trees.node_table(spark).withColumnsRenamed({"left": "left_node", "right": "right_node"})
    return rounded(table).withColumn("value", F.col("value") + F.lit(0.0))  # no negative zero


@query(
    "gbt_newton_gain",
    with_views(
        f"""SELECT feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM trees), 6) AS importance
            FROM (SELECT unnest([{", ".join(f"'{c}'" for c in CHURN_FEATURES)}]) AS feature) LEFT JOIN (SELECT {NAMED_SQL} AS feature, gain FROM trees) USING (feature)
            GROUP BY feature""",
        PC,
        *_newton_sql(2, 4, 0.05),
    ),
)
def gbt_newton_gain(spark, folder):
    """Importances by gain, as shares of all gains of the first two trees."""
    return rounded(W.fit_newton(_labelled(spark, folder), settings=FIRST_ROUNDS).importances(spark))


@query("gbt_newton")
def gbt_newton(spark, folder):
    """300 trees of second order on balanced train rows, rows and columns drawn per tree; scores for every customer."""
    rows, balanced = C.training_rows(_labelled(spark, folder))
    return C.score_customers(W.fit_newton(balanced), rows)


@query(
    "batch_score",
    with_views("SELECT customer_id, churn_score, churn_predicted, risk_tier FROM ps", PS),
)
def batch_score(spark, folder):
    """Every customer scored by a fixed logistic expression, training rows included."""
    return proxies.scored_customers(spark, folder).select("customer_id", "churn_score", "churn_predicted", "risk_tier")


COUNTS_SQL = """c AS (
  SELECT CAST(count(*) FILTER (WHERE churned = 1 AND churn_predicted = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (WHERE churned = 0 AND churn_predicted = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE churned = 0 AND churn_predicted = 0) AS DOUBLE) AS tn,
         CAST(count(*) FILTER (WHERE churned = 1 AND churn_predicted = 0) AS DOUBLE) AS fn FROM ps)"""


def _auc_sql(score: str) -> str:
    """Mann-Whitney with mid-ranks, independent of the threshold sweep."""
    return f"""(SELECT (sum(CASE WHEN churned = 1 THEN mid END) - count(*) FILTER (WHERE churned = 1)
                        * (count(*) FILTER (WHERE churned = 1) + 1) / CAST(2 AS DOUBLE))
                       / (CAST(count(*) FILTER (WHERE churned = 1) AS DOUBLE) * count(*) FILTER (WHERE churned = 0))
                FROM (SELECT churned, rank() OVER (ORDER BY {score})
                             + (count(*) OVER (PARTITION BY {score}) - 1) / CAST(2 AS DOUBLE) AS mid FROM ps))"""


@query(
    "binary_metrics",
    with_views(
        f"""SELECT 'fixed' AS model, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy,
                   round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
                   round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round({_auc_sql("churn_score")}, 6) AS roc_auc FROM c""",
        PS,
        COUNTS_SQL,
    ),
)
def binary_metrics(spark, folder):
    scored = scored_table(spark, folder, *OUTCOME)
    return rounded(E.binary_metrics(scored, "churned", "churn_predicted", "churn_score", "fixed"))


@query("roc_auc", with_views(f"SELECT round({_auc_sql('churn_score')}, 6) AS roc_auc", PS))
def roc_auc(spark, folder):
    return rounded(E.roc_auc(proxies.scored_customers(spark, folder), "churned", "churn_score"))


@query(
    "roc_points",
    with_views(
        """SELECT churn_score AS threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
                  round(sum(pos) OVER w / CAST(sum(pos) OVER () AS DOUBLE), 6) AS tpr,
                  round(sum(neg) OVER w / CAST(sum(neg) OVER () AS DOUBLE), 6) AS fpr
           FROM (SELECT churn_score, sum(churned) AS pos, sum(1 - churned) AS neg FROM ps GROUP BY churn_score)
           WINDOW w AS (ORDER BY churn_score DESC ROWS UNBOUNDED PRECEDING)""",
        PS,
    ),
)
def roc_points(spark, folder):
    return rounded(E.roc_points(scored_table(spark, folder, *OUTCOME), "churned", "churn_score"))


@query(
    "class_report",
    with_views(
        """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r
           UNION ALL SELECT 'accuracy', round((tp + tn) / (tp + fp + tn + fn), 6), round((tp + tn) / (tp + fp + tn + fn), 6),
                            round((tp + tn) / (tp + fp + tn + fn), 6), CAST(tp + fp + tn + fn AS BIGINT) FROM c
           UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                            CAST(sum(support) AS BIGINT) FROM r
           UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                            round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                            CAST(sum(support) AS BIGINT) FROM r""",
        PS,
        COUNTS_SQL,
        """r AS (SELECT '0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall,
                        2 * tn / (2 * tn + fn + fp) AS f1, CAST(tn + fp AS BIGINT) AS support FROM c
                 UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn),
                        CAST(tp + fn AS BIGINT) FROM c)""",
    ),
)
def class_report(spark, folder):
    return rounded(E.class_report(proxies.scored_customers(spark, folder), "churned", "churn_predicted"))


@query(
    "confusion_matrix",
    with_views(
        """SELECT churned AS actual, count(*) FILTER (WHERE churn_predicted = 0) AS predicted_0,
                  count(*) FILTER (WHERE churn_predicted = 1) AS predicted_1 FROM ps GROUP BY churned""",
        PS,
    ),
)
def confusion_matrix(spark, folder):
    return E.confusion_matrix(proxies.scored_customers(spark, folder), "churned", "churn_predicted")


# A second fixed scorer: inactivity alone, scaled to 0..1.
_SECOND = "least(days_since_last_purchase / CAST(600 AS DOUBLE), CAST(1 AS DOUBLE))"


def _metric_rows_sql(source: str, score: str, column: str) -> str:
    m = {
        "accuracy": "(tp + tn) / (tp + fp + tn + fn)",
        "precision": "tp / (tp + fp)",
        "recall": "tp / (tp + fn)",
        "f1": "2 * tp / (2 * tp + fp + fn)",
        "roc_auc": _auc_sql(score),
    }
    return " UNION ALL ".join(f"SELECT '{k}' AS metric, {v} AS {column} FROM {source}" for k, v in m.items())


@query(
    "model_compare",
    with_views(
        f"""SELECT metric, round(a, 6) AS first_value, round(b, 6) AS second_value,
                   CASE WHEN b >= a THEN 'inactivity' ELSE 'fixed' END AS winner
            FROM ({_metric_rows_sql("c", "churn_score", "a")}) JOIN ({_metric_rows_sql("c2", _SECOND, "b")}) USING (metric)""",
        PS,
        COUNTS_SQL,
        COUNTS_SQL.replace("c AS (", "c2 AS (").replace("churn_predicted = 1", f"{_SECOND} > 0.5").replace(
            "churn_predicted = 0", f"NOT ({_SECOND} > 0.5)"
        ),
    ),
)
def model_compare(spark, folder):
    """Metrics of two fixed scorers side by side; the second wins ties."""
    second = F.least(F.col("days_since_last_purchase") / F.lit(600.0), F.lit(1.0))
    scored = (
        scored_table(spark, folder, *OUTCOME, "days_since_last_purchase")
        .withColumn("second_score", second)
        .withColumn("second_predicted", (second > 0.5).cast("int"))
    )
    metrics = [
        E.binary_metrics(scored, "churned", "churn_predicted", "churn_score", "fixed"),
        E.binary_metrics(scored, "churned", "second_predicted", "second_score", "inactivity"),
    ]
    return rounded(E.compare_models(metrics, "fixed", "inactivity"))
