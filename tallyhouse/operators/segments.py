"""Scaling, clustering, cluster quality, naming and profiles of customer segments."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel

from tallyhouse.functions.expressions import percent, rate
from tallyhouse.labels import SEGMENT_FEATURES
from tallyhouse.operators.ranking import average_rank

Scaling = dict[str, tuple[float, float]]


def fit_scaling(df: DataFrame, columns: Sequence[str], filled: bool = False) -> Scaling:
    """Mean and population deviation per column, from one aggregate; a zero deviation is 1.

    Nulls are left out, or count as rows at the mean (``filled``), which is where ``to_vectors`` puts them.
    """
    share = {c: F.sqrt(F.try_divide(F.count(c), F.count(F.lit(1)))) if filled else F.lit(1.0) for c in columns}
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[(F.stddev_pop(c) * share[c]).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def apply_scaling(df: DataFrame, scaling: Scaling) -> DataFrame:
    return df.select(
        *[
            ((F.col(c) - F.lit(scaling[c][0])) / F.lit(scaling[c][1])).alias(c) if c in scaling else F.col(c)
            for c in df.columns
        ]
    )


def to_vectors(
    df: DataFrame,
    columns: Sequence[str],
    scaling: Scaling | None = None,
    output: str = "features",
    missing: float | None = None,
) -> DataFrame:
    """Add a vector of the columns, scaled when asked; the columns themselves stay as they are.

    A null is the mean where a column is scaled, else ``missing``; without that it is an error.
    """
    inputs = [f"_in_{c}" for c in columns]
    values = {c: F.col(c).cast("double") for c in columns}
    if missing is not None:
        values = {c: F.coalesce(v, F.lit(missing)) for c, v in values.items()}
    for c, (mean, deviation) in (scaling or {}).items():
        values[c] = F.coalesce((F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation), F.lit(0.0))
    wide = df.select("*", *[values[c].alias(i) for c, i in zip(columns, inputs, strict=True)])
    return VectorAssembler(inputCols=inputs, outputCol=output).transform(wide).drop(*inputs)


def fit_kmeans(
    vectors: DataFrame,
    ks: Sequence[int],
    seed: int = 42,
    restarts: int = 10,
    max_iter: int = 300,
    parallelism: int = 8,
) -> dict[int, KMeansModel]:
    """Per k the lowest-cost model of several seeds.

    All fits read one frame, which the caller caches, and run side by side: a fit has
    many short jobs, so the executors would idle between those of a single one.
    """

    @inheritable_thread_target(vectors.sparkSession)
    def fit(task: tuple[int, int]) -> KMeansModel:
        return KMeans(k=task[0], seed=task[1], maxIter=max_iter, tol=1e-4).fit(vectors)

    tasks = [(k, s) for k in ks for s in range(seed, seed + restarts)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        models = list(zip(tasks, pool.map(fit, tasks, chunksize=1), strict=True))
    return {k: min((m for (j, _), m in models if j == k), key=lambda m: m.summary.trainingCost) for k in ks}


def sweep_k(
    vectors: DataFrame, k_min: int = 2, k_max: int = 8, seed: int = 42, restarts: int = 10
) -> DataFrame:
    """``k, inertia, silhouette, best``; silhouette with squared Euclidean distance."""
    cached = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    judge = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean")

    @inheritable_thread_target(vectors.sparkSession)
    def judged(found: tuple[int, KMeansModel]) -> tuple[int, float, float]:
        k, model = found
        return k, float(model.summary.trainingCost), float(judge.evaluate(model.transform(cached)))

    models = fit_kmeans(cached, range(k_min, k_max + 1), seed, restarts)
    with ThreadPool(len(models)) as pool:
        rows = pool.map(judged, models.items(), chunksize=1)
    cached.unpersist()
    top = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return vectors.sparkSession.createDataFrame(
        [(*r, int(r[0] == top)) for r in rows], "k int, inertia double, silhouette double, best int"
    )


def assign_clusters(
    df: DataFrame,
    columns: Sequence[str] = tuple(SEGMENT_FEATURES),
    k: int = 4,
    seed: int = 42,
    restarts: int = 10,
) -> DataFrame:
    """Add ``cluster`` from K-Means on the scaled columns; a missing measure lies at the mean."""
    vectors = to_vectors(df, columns, fit_scaling(df, columns, filled=True))
    cached = vectors.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    model = fit_kmeans(cached, [k], seed, restarts)[k]
    cached.unpersist()
    return model.transform(vectors).select(*df.columns, F.col("prediction").alias("cluster"))


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """Mean squared-Euclidean silhouette per cluster: ``cluster, n, silhouette``.

    The mean squared distance from a point to a cluster follows from that cluster's
    count, column sums and sum of squared norms, so one pass builds a row per cluster
    and a second one compares each point with those rows; no pairs of points are formed.
    """
    norm = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))
    totals = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(norm).alias("squares"),
        F.array(*[F.sum(c) for c in columns]).alias("sums"),
    )
    rows = totals.collect()  # one row per cluster
    if len(rows) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    own, other = [], []
    for row in rows:
        dot = sum((F.col(c) * F.lit(s) for c, s in zip(columns, row["sums"], strict=True)), F.lit(0.0))
        total = norm * F.lit(row["n"]) - 2 * dot + F.lit(row["squares"])
        mine = F.col(cluster) == F.lit(row[cluster])
        own.append(F.when(mine, total / F.lit(max(row["n"] - 1, 1))))
        other.append(F.when(~mine, total / F.lit(row["n"])))
    sizes = F.coalesce(*[F.when(F.col(cluster) == F.lit(r[cluster]), F.lit(r["n"])) for r in rows])
    a, b = F.coalesce(*own), F.least(*other)
    width = F.when(sizes == 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.avg(width).alias("silhouette"))


# Loadings nearer than this share of the largest one count as equally large.
SIGN_TIE = 1e-6


def principal_axes(df: DataFrame, identity: str, columns: Sequence[str], k: int = 2) -> DataFrame:
    """Coordinates on the first k principal axes of the scaled columns.

    The covariance of two columns is taken over the rows that have both, in one aggregate; a missing measure adds nothing
    to a coordinate.
    The largest loading of each axis is made positive; among loadings that are as large but for
    ``SIGN_TIE`` of it the first feature decides, so signs do not hang on rounding. Columns: id, ``pca_1..k``, ``explained_1..k`` (variance ratios).
    """
    scaled = apply_scaling(df.select(identity, *columns), fit_scaling(df, columns))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = scaled.agg(*[F.avg(F.col(columns[i]) * F.col(columns[j])).alias(f"m_{i}_{j}") for i, j in pairs]).first()
    covariance = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        covariance[i, j] = covariance[j, i] = row[f"m_{i}_{j}"] or 0.0
    values, axes = np.linalg.eigh(covariance)
    largest = np.argsort(-abs(values), kind="stable")[:k]
    loadings, shares = axes[:, largest], values[largest] / (np.trace(covariance) or 1.0)
    size = abs(loadings)
    deciding = (size >= size.max(axis=0) * (1 - SIGN_TIE)).argmax(axis=0)
    loadings = loadings * [1.0 if loadings[deciding[j], j] >= 0 else -1.0 for j in range(k)]

    def along(j: int) -> Column:
        return sum((F.coalesce(F.col(c), F.lit(0.0)) * F.lit(float(w)) for c, w in zip(columns, loadings[:, j], strict=True)), F.lit(0.0))

    return scaled.select(
        identity,
        *[along(j).alias(f"pca_{j + 1}") for j in range(k)],
        *[F.lit(float(shares[j])).alias(f"explained_{j + 1}") for j in range(k)],
    )


def cluster_means(
    df: DataFrame, cluster: str = "cluster", columns: Sequence[str] = tuple(SEGMENT_FEATURES)
) -> DataFrame:
    """Feature means and churn rate per cluster; ``churned`` is 0/1."""
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns], F.avg("churned").alias("churn_rate"))


def name_segments(means: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``cluster, segment``: codes given greedily to the rows of a cluster profile.

    First the highest sum of the ranks of inactivity and churn rate is ``at_risk``, then
    of those left the highest order value is ``high_value``, then the highest engagement
    ``loyal``; the rest are ``price_hunter``. Ties go to the lowest cluster id.
    """
    ranked = means.withColumn(
        "risk", average_rank("days_since_last_purchase") + average_rank("churn_rate")
    ).withColumn("segment", F.lit(None).cast("string"))
    for code, measure in (("at_risk", "risk"), ("high_value", "avg_order_value"), ("loyal", "engagement_score")):
        order = Window.orderBy(F.col("segment").isNotNull().cast("int"), F.desc(measure), F.asc(cluster))
        free = F.col("segment").isNull() & (F.row_number().over(order) == 1)
        ranked = ranked.withColumn("segment", F.when(free, F.lit(code)).otherwise(F.col("segment")))
    return ranked.select(cluster, F.coalesce("segment", F.lit("price_hunter")).alias("segment"))


def segment_profile(
    df: DataFrame, segment: str = "segment", columns: Sequence[str] = tuple(SEGMENT_FEATURES)
) -> DataFrame:
    """Size, share, % churned, % loyal and feature means per segment."""
    counted = df.where(F.col(segment).isNotNull()).groupBy(segment).agg(
        F.count("customer_id").alias("customers"),
        (rate(F.col("churned") == 1) * 100).alias("pct_churned"),
        (rate(F.col("loyalty_status") == "Yes") * 100).alias("pct_loyalty"),
        *[F.avg(c).alias(c) for c in columns],
    )
    everyone = F.sum("customers").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("pct_of_all", percent(F.col("customers"), everyone))
