"""Risk tiers crossed with segments: concentrations, score statistics, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.functions.expressions import percent, rate, rename_values
from tallyhouse.labels import LOST_PATTERN, RECOVERABLE_PATTERN, SEGMENT_NAMES, SEGMENT_ORDER
from tallyhouse.operators.reshape import reindex
from tallyhouse.operators.sampling import sample_fixed
from tallyhouse.operators.stats import describe


def tier_summary(scores: DataFrame) -> DataFrame:
    """Customers and mean score in percent per tier, highest first."""
    return (
        scores.groupBy("risk_tier")
        .agg(F.count(F.lit(1)).alias("customers"), F.round(F.avg("churn_score") * 100, 1).alias("avg_score_pct"))
        .orderBy(F.desc("avg_score_pct"))
    )


def risk_share(df: DataFrame, segment: str = "segment", threshold: float = 0.5) -> DataFrame:
    """Percent of each segment whose score is at least the threshold."""
    named = df.where(F.col(segment).isNotNull())
    return named.groupBy(segment).agg((rate(F.col("churn_score") >= threshold) * 100).alias("pct_at_risk"))


def critical_by_segment(
    df: DataFrame, order: Sequence[str] = tuple(SEGMENT_ORDER), segment: str = "segment"
) -> DataFrame:
    """Critical customers per segment with shares and means; segments without any are left out.

    One conditional aggregate gives the critical rows, the segment size and, summed over
    segments, the size of the whole.
    """
    hit = F.col("risk_tier") == "critical"
    only = lambda c: F.avg(F.when(hit, F.col(c)))
    sized = df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if(hit).alias("customers"),
        only("churn_score").alias("avg_score"),
        only("days_since_last_purchase").alias("avg_days"),
        only("avg_order_value").alias("avg_value"),
        only("engagement_score").alias("avg_engagement"),
    )
    everyone = F.sum("members").over(Window.partitionBy(F.lit(0)))
    shares = sized.withColumn("pct_of_all", percent(F.col("customers"), everyone)).withColumn(
        "pct_of_segment", percent(F.col("customers"), F.col("members"))
    )
    return reindex(shares, segment, order).where("customers > 0").drop("members")


def score_stats(df: DataFrame, order: Sequence[str] = tuple(SEGMENT_ORDER), segment: str = "segment") -> DataFrame:
    """Mean, median, deviation, minimum and maximum of the score per segment, in fixed order."""
    stats = describe(df, ["churn_score"], [segment]).select(
        segment, "mean", F.col("p50").alias("median"), "std", "min", "max"
    )
    return reindex(stats, segment, order)


def hotspot(critical: DataFrame, segment: str = "segment") -> DataFrame:
    """The segment with the highest critical share, and how many criticals look recoverable."""
    named = critical.withColumn("segment_name", rename_values(F.col(segment), SEGMENT_NAMES))
    return named.agg(
        F.max_by(segment, F.struct("pct_of_segment", -F.col("position"))).alias("segment"),
        F.max("pct_of_segment").alias("pct_of_segment"),
        F.coalesce(F.sum(F.when(F.col("segment_name").rlike(RECOVERABLE_PATTERN), F.col("customers"))), F.lit(0))
        .cast("long")
        .alias("recoverable"),
    )


def recoverable_or_lost(critical: DataFrame, segment: str = "segment") -> DataFrame:
    """Critical customers whose segment name marks them lost, and the others."""
    name = rename_values(F.col(segment), SEGMENT_NAMES)
    return critical.agg(
        F.coalesce(F.sum("customers"), F.lit(0)).cast("long").alias("critical"),
        F.coalesce(F.sum(F.when(name.rlike(LOST_PATTERN), F.col("customers"))), F.lit(0)).cast("long").alias("lost"),
    ).withColumn("recoverable", F.col("critical") - F.col("lost"))


def risk_map(df: DataFrame, size: int = 1500, seed: int = 42, segment: str = "segment") -> DataFrame:
    """Seeded sample for the risk map; the marker size grows with the score."""
    chosen = df.select("customer_id", segment, "days_since_last_purchase", "engagement_score", "churn_score")
    return sample_fixed(chosen, "customer_id", size, seed).withColumn("marker", F.col("churn_score") * 120 + 10)


def executive_summary(df: DataFrame, segment: str = "segment") -> DataFrame:
    """One row: base, churn rate, critical and recoverable customers, best and worst segment.

    Everything follows from one aggregate per segment.
    """
    per_segment = df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("members"),
        F.sum("churned").alias("churners"),
        F.count_if(F.col("risk_tier") == "critical").alias("critical"),
        F.avg("churn_score").alias("score"),
    )
    name = rename_values(F.col(segment), SEGMENT_NAMES)
    lost = F.coalesce(F.sum(F.when(name.rlike(LOST_PATTERN), F.col("critical"))), F.lit(0))
    summed = per_segment.agg(
        F.sum("members").alias("customers"),
        F.sum("churners").alias("churners"),
        F.sum("critical").alias("critical"),
        (F.sum("critical") - lost).cast("long").alias("recoverable"),
        F.min_by(segment, F.struct("score", segment)).alias("healthiest"),
        F.min_by(segment, F.struct(-F.col("score"), segment)).alias("riskiest"),
    )
    return summed.select(
        "customers",
        percent(F.col("churners"), F.col("customers")).alias("churn_rate_pct"),
        "critical",
        percent(F.col("critical"), F.col("customers")).alias("critical_pct"),
        "recoverable",
        percent(F.col("recoverable"), F.col("customers")).alias("recoverable_pct"),
        "healthiest",
        "riskiest",
    )
