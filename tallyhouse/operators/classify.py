"""Churn classifiers: balanced training data, fitting, scoring, importances."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from tallyhouse.config import shared_dir, stored
from tallyhouse.functions.expressions import bin_right_closed
from tallyhouse.labels import CHURN_FEATURES, TIER_EDGES, TIER_LABELS
from tallyhouse.operators.neighbors import oversample_minority
from tallyhouse.operators.sampling import stratified_split
from tallyhouse.operators.segments import Scaling, fit_scaling, to_vectors

ROWS_PER_TASK = 20_000
# Where the trees put a missing feature: below every threshold, as those of second order do (Spark refuses infinity).
BELOW = -1e300


@dataclass
class Classifier:
    """A fitted model with the features and, where it needs one, the scaling it expects."""

    name: str
    model: Model
    features: list[str]
    scaling: Scaling | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``raw_score`` (probability of class 1) and ``predicted`` (score above 0.5)."""
        if isinstance(self.model, LogisticRegressionModel):
            probability = self._linear()
            scored = df
        else:
            probability = vector_to_array("probability")[1]
            scored = self.model.transform(to_vectors(df, self.features, self.scaling, missing=BELOW))
        return scored.select(
            *df.columns, probability.alias("raw_score"), (probability > 0.5).cast("int").alias("predicted")
        )

    def _linear(self) -> Column:
        """The regression as one generated expression: no vectors, no function calls per row. A null is the mean."""
        z = F.lit(float(self.model.intercept))
        for name, weight in zip(self.features, self.model.coefficients.toArray(), strict=True):
            mean, deviation = self.scaling[name]
            part = F.lit(float(weight)) * (F.col(name).cast("double") - F.lit(mean)) / F.lit(deviation)
            z = z + F.coalesce(part, F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def training_rows(
    df: DataFrame,
    features: Sequence[str] = tuple(CHURN_FEATURES),
    label: str = "churned",
    identity: str = "customer_id",
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(all rows with ``split``, balanced train rows); the test rows stay as they are.

    The balanced rows are written to the shared folder: every fit reads them many times
    and the neighbour search behind them must not run again.
    """
    split = stratified_split(df, label, identity, 0.8, seed)
    train = split.where(F.col("split") == "train")
    return split, stored(oversample_minority(train, label, identity, features, seed=seed), "balanced")


def fit_logistic(
    train: DataFrame,
    features: Sequence[str] = tuple(CHURN_FEATURES),
    label: str = "churned",
    inverse_penalty: float = 1.0,
    max_iter: int = 1000,
) -> Classifier:
    """L2 logistic regression on scaled features.

    The penalty is stated per data set, Spark averages the loss over rows: hence 1/(C n).
    A missing feature is the mean, in the fit and in scores.
    """
    scaling = fit_scaling(train, features, filled=True)
    vectors = to_vectors(train, features, scaling).select("features", F.col(label).cast("double").alias("label"))
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    model = LogisticRegression(
        maxIter=max_iter,
        regParam=1.0 / (inverse_penalty * vectors.count()),
        elasticNetParam=0.0,
        standardization=False,
    ).fit(vectors)
    vectors.unpersist()
    return Classifier("logistic", model, list(features), scaling)


def fit_boosted(
    train: DataFrame,
    features: Sequence[str] = tuple(CHURN_FEATURES),
    label: str = "churned",
    rounds: int = 300,
    depth: int = 4,
    step: float = 0.05,
    seed: int = 42,
) -> Classifier:
    """Boosted trees on unscaled features; lineage is cut every 25 rounds. A missing feature lies below every threshold.

    A round is a few short jobs, so tasks hold up to ``ROWS_PER_TASK`` rows each.
    """
    shared_dir(train.sparkSession)
    vectors = to_vectors(train, features, missing=BELOW).select("features", F.col(label).cast("double").alias("label"))
    vectors = vectors.coalesce(-(-train.count() // ROWS_PER_TASK) or 1).persist(StorageLevel.MEMORY_AND_DISK)
    model = GBTClassifier(
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=seed,
        checkpointInterval=25,
        cacheNodeIds=True,
    ).fit(vectors)
    vectors.unpersist()
    return Classifier("boosted", model, list(features))


def importances(classifier: Classifier, spark) -> DataFrame:
    """``feature, importance`` of boosted trees, or the absolute coefficients."""
    model = classifier.model
    if isinstance(model, LogisticRegressionModel):
        weights = abs(model.coefficients.toArray())
    else:
        weights = model.featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(classifier.features, weights, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def score_customers(classifier: Classifier, customers: DataFrame, identity: str = "customer_id") -> DataFrame:
    """Score every customer: six-decimal score, prediction, tier cut on the raw score."""
    keep = [c for c in ("split",) if c in customers.columns]
    return classifier.score(customers).select(
        identity,
        F.round("raw_score", 6).alias("churn_score"),
        F.col("predicted").alias("churn_predicted"),
        bin_right_closed(F.col("raw_score"), TIER_EDGES, TIER_LABELS).alias("risk_tier"),
        *keep,
    )
