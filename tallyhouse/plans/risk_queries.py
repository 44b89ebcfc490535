"""Segments crossed with risk tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.config import stored
from tallyhouse.functions import expressions as X
from tallyhouse.labels import SEGMENT_ORDER, TIER_ORDER
from tallyhouse.operators import reshape as R, risk as K
from tallyhouse.plans.load_queries import PSEG, segmented
from tallyhouse.plans.registry import query, rounded
from tallyhouse.sources import proxies
from tallyhouse.sources.proxy_sql import PS, with_views

_POSITION = f"CAST(list_position({SEGMENT_ORDER}, segment) - 1 AS INTEGER)"


@query(
    "risk_tier_summary",
    with_views(
        """SELECT risk_tier, count(*) AS customers, round(avg(churn_score) * 100, 1) AS avg_score_pct
           FROM ps GROUP BY risk_tier ORDER BY avg_score_pct DESC""",
        PS,
    ),
)
def risk_tier_summary(spark, folder):
    return K.tier_summary(proxies.scored_customers(spark, folder))


@query(
    "risk_share_by_segment",
    with_views(
        """SELECT segment, round(avg(CASE WHEN churn_score >= 0.5 THEN 1 ELSE 0 END) * 100, 6) AS pct_at_risk
           FROM seg GROUP BY segment""",
        PSEG,
    ),
)
def risk_share_by_segment(spark, folder):
    return rounded(K.risk_share(segmented(spark, folder)))


@query(
    "crosstab_counts",
    with_views(
        "SELECT segment, "
        + ", ".join(f"count(*) FILTER (WHERE risk_tier = '{t}') AS {t}" for t in TIER_ORDER)
        + " FROM seg GROUP BY segment",
        PSEG,
    ),
)
def crosstab_counts(spark, folder):
    return R.crosstab(segmented(spark, folder), "segment", "risk_tier", TIER_ORDER)


@query(
    "crosstab_pct",
    with_views(
        "SELECT segment, "
        + ", ".join(f"round(count(*) FILTER (WHERE risk_tier = '{t}') * CAST(100 AS DOUBLE) / count(*), 6) AS {t}" for t in TIER_ORDER)
        + " FROM seg WHERE risk_tier IS NOT NULL GROUP BY segment",
        PSEG,
    ),
)
def crosstab_pct(spark, folder):
    """Segment by risk tier in row percentages: the flagship report."""
    return rounded(R.crosstab_percent(segmented(spark, folder), "segment", "risk_tier", TIER_ORDER))


@query(
    "stack_offsets",
    with_views(
        f"""SELECT segment, risk_tier, round(pct, 6) AS pct,
                   round(coalesce(sum(pct) OVER (PARTITION BY segment ORDER BY list_position({TIER_ORDER}, risk_tier)
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS bottom
            FROM (SELECT segment, risk_tier, count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY segment) AS pct
                  FROM seg WHERE risk_tier IS NOT NULL GROUP BY segment, risk_tier)""",
        PSEG,
    ),
)
def stack_offsets(spark, folder):
    """Parts of each segment's bar with the height where each part starts."""
    wide = R.crosstab_percent(segmented(spark, folder), "segment", "risk_tier", TIER_ORDER)
    long = R.melt(wide, ["segment"], TIER_ORDER, "risk_tier", "pct").where("pct > 0")
    placed = long.withColumn("position", X.ordinal(F.col("risk_tier"), TIER_ORDER))
    return rounded(R.stack_offsets(placed, "segment", "position", "pct").drop("position"))


CRITICAL_SQL = f"""critical AS (
  SELECT {_POSITION} AS position, segment, count(*) FILTER (WHERE risk_tier = 'critical') AS customers,
         avg(churn_score) FILTER (WHERE risk_tier = 'critical') AS avg_score,
         avg(days_since_last_purchase) FILTER (WHERE risk_tier = 'critical') AS avg_days,
         avg(avg_order_value) FILTER (WHERE risk_tier = 'critical') AS avg_value,
         avg(engagement_score) FILTER (WHERE risk_tier = 'critical') AS avg_engagement,
         count(*) FILTER (WHERE risk_tier = 'critical') * CAST(100 AS DOUBLE) / (SELECT count(*) FROM seg) AS pct_of_all,
         count(*) FILTER (WHERE risk_tier = 'critical') * CAST(100 AS DOUBLE) / count(*) AS pct_of_segment
  FROM seg GROUP BY segment HAVING count(*) FILTER (WHERE risk_tier = 'critical') > 0)"""


@query(
    "critical_by_segment",
    with_views(
        """SELECT position, segment, customers, round(avg_score, 4) AS avg_score, round(avg_days, 4) AS avg_days,
                  round(avg_value, 4) AS avg_value, round(avg_engagement, 4) AS avg_engagement,
                  round(pct_of_all, 4) AS pct_of_all, round(pct_of_segment, 4) AS pct_of_segment FROM critical""",
        PSEG,
        CRITICAL_SQL,
    ),
)
def critical_by_segment(spark, folder):
    return rounded(K.critical_by_segment(segmented(spark, folder)), 4)


@query(
    "critical_hotspot",
    with_views(
        """SELECT (SELECT segment FROM critical ORDER BY pct_of_segment DESC, position LIMIT 1) AS segment,
                  (SELECT round(max(pct_of_segment), 6) FROM critical) AS pct_of_segment,
                  CAST((SELECT coalesce(sum(customers), 0) FROM critical WHERE segment <> 'at_risk') AS BIGINT) AS recoverable""",
        PSEG,
        CRITICAL_SQL,
    ),
)
def critical_hotspot(spark, folder):
    return rounded(K.hotspot(K.critical_by_segment(segmented(spark, folder))))


@query(
    "recoverable_vs_lost",
    with_views(
        """SELECT CAST(sum(customers) AS BIGINT) AS critical,
                  CAST(coalesce(sum(customers) FILTER (WHERE segment = 'at_risk'), 0) AS BIGINT) AS lost,
                  CAST(coalesce(sum(customers) FILTER (WHERE segment <> 'at_risk'), 0) AS BIGINT) AS recoverable FROM critical""",
        PSEG,
        CRITICAL_SQL,
    ),
)
def recoverable_vs_lost(spark, folder):
    return K.recoverable_or_lost(K.critical_by_segment(segmented(spark, folder)))


@query(
    "score_stats_by_segment",
    with_views(
        f"""SELECT {_POSITION} AS position, segment, round(avg(churn_score), 6) AS mean, round(median(churn_score), 6) AS median,
                   round(stddev_samp(churn_score), 6) AS std, min(churn_score) AS min, max(churn_score) AS max
            FROM seg GROUP BY segment""",
        PSEG,
    ),
)
def score_stats_by_segment(spark, folder):
    stats = K.score_stats(stored(segmented(spark, folder).select("segment", "churn_score"), "scored"))
    return rounded(stats).select("position", "segment", "mean", "median", "std", "min", "max")


@query(
    "risk_map_sample",
    with_views(
        """SELECT customer_id, segment, days_since_last_purchase, engagement_score, churn_score,
                  round(churn_score * 120 + 10, 6) AS marker
           FROM seg ORDER BY substr(md5(customer_id || ':42'), 1, 13), customer_id LIMIT 1500""",
        PSEG,
    ),
)
def risk_map_sample(spark, folder):
    return rounded(K.risk_map(segmented(spark, folder)))


@query(
    "exec_summary",
    with_views(
        """SELECT count(*) AS customers, round(avg(churned) * 100, 6) AS churn_rate_pct,
                  count(*) FILTER (WHERE risk_tier = 'critical') AS critical,
                  round(count(*) FILTER (WHERE risk_tier = 'critical') * CAST(100 AS DOUBLE) / count(*), 6) AS critical_pct,
                  count(*) FILTER (WHERE risk_tier = 'critical' AND segment <> 'at_risk') AS recoverable,
                  round(count(*) FILTER (WHERE risk_tier = 'critical' AND segment <> 'at_risk') * CAST(100 AS DOUBLE) / count(*), 6)
                    AS recoverable_pct,
                  (SELECT segment FROM seg GROUP BY segment ORDER BY avg(churn_score), segment LIMIT 1) AS healthiest,
                  (SELECT segment FROM seg GROUP BY segment ORDER BY avg(churn_score) DESC, segment LIMIT 1) AS riskiest
           FROM seg""",
        PSEG,
    ),
)
def exec_summary(spark, folder):
    return rounded(K.executive_summary(segmented(spark, folder)))


