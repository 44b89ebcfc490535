"""Classifier metrics from one conditional aggregate, and curves over distinct scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.config import SMALL_ROWS
from tallyhouse.operators.ranking import running_totals

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def _ratio(part: Column, whole: Column) -> Column:
    """A ratio that is 0 where nothing was counted."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    y, p = F.col(label), F.col(predicted)
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """``actual, predicted_0, predicted_1``, both classes always listed."""
    return confusion_counts(df, label, predicted).select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("actual"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
                F.struct(F.lit(1).alias("actual"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
            )
        )
    )


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score, keyed so that ascending order is descending score."""
    return df.groupBy((-F.col(score)).alias("rank_key")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")
    )


def roc_points(df: DataFrame, label: str, score: str, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``threshold, tp, fp, tpr, fpr`` at every distinct score, highest first."""
    swept = running_totals(_by_score(df, label, score), ["rank_key"], {"tp": "pos", "fp": "neg"}, (), max_rows)
    whole = df.agg(
        F.sum(F.col(label).cast("long")).alias("p"), F.sum((1 - F.col(label)).cast("long")).alias("n")
    ).first()
    return swept.select(
        (-F.col("rank_key")).alias("threshold"),
        "tp",
        "fp",
        _ratio(F.col("tp"), F.lit(whole["p"])).alias("tpr"),
        _ratio(F.col("fp"), F.lit(whole["n"])).alias("fpr"),
    )


def roc_auc(df: DataFrame, label: str, score: str, max_rows: int = SMALL_ROWS) -> DataFrame:
    """One row ``roc_auc``: share of (positive, negative) pairs in order, ties one half.

    Equal to the area under ``roc_points``; whole counts keep it exact.
    """
    swept = running_totals(_by_score(df, label, score), ["rank_key"], {"tp": "pos"}, (), max_rows)
    won = F.sum((F.col("tp") - F.col("pos") + F.col("pos") / 2.0) * F.col("neg"))
    return swept.agg(won.alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        F.try_divide(F.col("won"), F.col("p").cast("double") * F.col("n")).alias("roc_auc")
    )


def binary_metrics(df: DataFrame, label: str, predicted: str, score: str, model: str) -> DataFrame:
    """One row ``model, accuracy, precision, recall, f1, roc_auc`` for class 1."""
    c = confusion_counts(df, label, predicted).first()
    area = roc_auc(df, label, score).first()["roc_auc"]
    total = c["tp"] + c["fp"] + c["tn"] + c["fn"]
    share = lambda part, whole: part / whole if whole else 0.0
    row = (
        model,
        share(c["tp"] + c["tn"], total),
        share(c["tp"], c["tp"] + c["fp"]),
        share(c["tp"], c["tp"] + c["fn"]),
        share(2 * c["tp"], 2 * c["tp"] + c["fp"] + c["fn"]),
        area,
    )
    return df.sparkSession.createDataFrame([row], "model string, " + ", ".join(f"{m} double" for m in METRICS))


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """``class, precision, recall, f1, support`` per class, then accuracy and averages."""
    c = confusion_counts(df, label, predicted)
    rows = []
    for name, tp, fp, fn in (("0", "tn", "fn", "fp"), ("1", "tp", "fp", "fn")):
        hit, wrong, lost = F.col(tp), F.col(fp), F.col(fn)
        rows.append(
            F.struct(
                F.lit(name).alias("class"),
                _ratio(hit, hit + wrong).alias("precision"),
                _ratio(hit, hit + lost).alias("recall"),
                _ratio(2 * hit, 2 * hit + wrong + lost).alias("f1"),
                (hit + lost).alias("support"),
            )
        )
    classes = c.select(F.inline(F.array(*rows)), "tp", "tn")
    measures = ["precision", "recall", "f1"]
    totals = classes.agg(
        F.sum("support").alias("support"),
        (F.first("tp") + F.first("tn")).alias("hits"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in measures],
    )
    accuracy = _ratio(F.col("hits"), F.col("support"))
    summary = totals.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("class"), *[accuracy.alias(m) for m in measures], "support"),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("class"),
                        *[F.col(f"{kind}_{m}").alias(m) for m in measures],
                        "support",
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        )
    )
    return classes.drop("tp", "tn").unionByName(summary)


def compare_models(metrics: Sequence[DataFrame], first: str, second: str) -> DataFrame:
    """``metric, first, second, winner`` of two one-row metric frames; the second wins ties."""
    both = reduce(DataFrame.unionByName, metrics).unpivot(["model"], METRICS, "metric", "value")
    side = lambda name: F.max(F.when(F.col("model") == name, F.col("value")))
    return (
        both.groupBy("metric")
        .agg(side(first).alias("first_value"), side(second).alias("second_value"))
        .withColumn("winner", F.when(F.col("second_value") >= F.col("first_value"), second).otherwise(first))
    )
