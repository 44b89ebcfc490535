from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import classify as C, evaluate as E, neighbors as N, newton as W, sampling, segments as G


def brute_neighbors(pdf, features, k):
    x = pdf[features].to_numpy(float)
    out = {}
    for i, name in enumerate(pdf.id):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[name] = sorted((d[j], pdf.id.iloc[j]) for j in range(len(x)) if j != i)[:k]
    return out


@pytest.mark.parametrize("slab_rows,max_rows", [(512, 20_000), (16, 20_000), (16, 40)])
def test_neighbors_are_exact(spark, slab_rows, max_rows):
    """Several slabs, a third of the points identical, and the written-table path."""
    rng = np.random.default_rng(5)
    n = 150
    pdf = pd.DataFrame(rng.normal(size=(n, 3)), columns=["a", "b", "c"])
    pdf.loc[::3, ["a", "b", "c"]] = [0.5, 0.5, 0.5]
    pdf["id"] = [f"p{i:03d}" for i in range(n)]
    got = N.nearest_neighbors(spark.createDataFrame(pdf), "id", ["a", "b", "c"], 5, slab_rows, max_rows).toPandas()
    want = brute_neighbors(pdf, ["a", "b", "c"], 5)
    for name, part in got.sort_values("rank").groupby("id"):
        assert list(part.neighbor) == [i for _, i in want[name]] and list(part["rank"]) == [1, 2, 3, 4, 5]
        assert np.allclose(part.distance, [d for d, _ in want[name]])
    assert len(got) == 5 * n


@pytest.mark.parametrize("slab_rows", [4, 16, 512])
def test_neighbor_ties_follow_the_ids(spark, slab_rows):
    """Sixty equal points and whole-number features: the same rows at any slab size."""
    rows = [(f"p{i:03d}", 1.0, 1.0) for i in range(60)] + [(f"q{i:03d}", float(i % 4), float(i % 3)) for i in range(40)]
    pdf = pd.DataFrame(rows, columns=["id", "a", "b"])
    got = N.nearest_neighbors(spark.createDataFrame(pdf), "id", ["a", "b"], 3, slab_rows, 30).toPandas()
    want = brute_neighbors(pdf, ["a", "b"], 3)
    for name, part in got.sort_values("rank").groupby("id"):
        assert list(part.neighbor) == [i for _, i in want[name]]
    assert len(got) == 300


def test_neighbors_of_few_points(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 5.0)], "id string, v double")
    got = N.nearest_neighbors(df, "id", ["v"], 5).orderBy("id", "rank").collect()
    assert [(r.id, r.neighbor) for r in got] == [("a", "b"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "a")]
    assert N.nearest_neighbors(df.limit(1), "id", ["v"], 5).count() == 0


def test_oversampling(spark):
    rng = np.random.default_rng(1)
    rows = [(f"m{i}", float(i), int(i * 10), 1) for i in range(8)]
    rows += [(f"z{i}", float(v), 3, 0) for i, v in enumerate(rng.normal(size=43))]
    df = spark.createDataFrame(rows, "id string, v double, w int, y int")
    out = N.oversample_minority(df, "y", "id", ["v", "w"])
    sizes = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert sizes == {0: 43, 1: 43}
    assert dict(out.dtypes)["w"] == "int" and out.select("id").distinct().count() == 86
    for r in out.where("synthetic = 1").collect():
        assert 0.0 <= r.v <= 7.0 and int(r.v * 10 + 1e-9) == r.w  # on the segment between two minority rows
    again = {(r.id, r.v) for r in N.oversample_minority(df.repartition(7), "y", "id", ["v", "w"]).collect()}
    assert again == {(r.id, r.v) for r in out.collect()}


def test_oversampling_a_tiny_minority(spark):
    """Two base rows and thousands of copies: several chunks per base row."""
    rare = spark.createDataFrame([("a", 1.0, 1), ("b", 3.0, 1)], "id string, v double, y int")
    rest = spark.range(5001).select(F.concat(F.lit("z"), "id").alias("id"), F.lit(9.0).alias("v"), F.lit(0).alias("y"))
    out = N.oversample_minority(rare.unionByName(rest), "y", "id", ["v"]).where("y = 1")
    assert out.count() == 5001 and out.select("id").distinct().count() == 5001
    low, high = out.agg(F.min("v"), F.max("v")).first()
    assert low >= 1.0 and high <= 3.0
    assert 1.9 < out.agg(F.avg("v")).first()[0] < 2.1


def test_oversampling_edge_sizes(spark):
    lone = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 0), ("c", 3.0, 0)], "id string, v double, y int")
    out = N.oversample_minority(lone, "y", "id", ["v"])
    assert sorted(r.v for r in out.where("y = 1").collect()) == [1.0, 1.0]
    even = lone.where("id <> 'c'")
    assert N.oversample_minority(even, "y", "id", ["v"]).where("synthetic = 1").count() == 0


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_split_is_exact_per_class(spark, accuracy):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    out = sampling.stratified_split(df, "y", "id", 0.8, 42, accuracy)
    got = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    ones = 715
    assert got == {
        (1, "train"): round(0.8 * ones), (1, "test"): ones - round(0.8 * ones),
        (0, "train"): round(0.8 * (5000 - ones)), (0, "test"): 5000 - ones - round(0.8 * (5000 - ones)),
    }
    other = sampling.stratified_split(df.repartition(11), "y", "id", 0.8, 42)
    assert out.where("split = 'test'").join(other.where("split = 'test'"), "id").count() == 1000


def test_sample_has_exact_size(spark):
    df = spark.range(300)
    assert sampling.sample_fixed(df, "id", 100).count() == 100
    assert sampling.sample_fixed(df, "id", 1000).count() == 300


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(11)
    centers = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 0], [0, 0, 9]])
    truth = rng.integers(0, 4, 800)
    pdf = pd.DataFrame(centers[truth] + rng.normal(size=(800, 3)), columns=["a", "b", "c"])
    pdf["truth"] = truth
    pdf["id"] = [str(i) for i in range(800)]
    pdf["y"] = ((pdf.a > 5) & (rng.random(800) < 0.95)).astype(int)
    return pdf, spark.createDataFrame(pdf)


def test_kmeans_recovers_blobs(spark, blobs):
    pdf, df = blobs
    out = G.assign_clusters(df, ["a", "b", "c"], 4, restarts=3)
    assert set(out.columns) == {*df.columns, "cluster"}
    assert out.groupBy("truth", "cluster").count().count() == 4
    assert out.agg(F.max(F.abs(F.col("a")))).first()[0] == pytest.approx(pdf.a.abs().max())
    vectors = G.to_vectors(df, ["a", "b", "c"]).select("features")
    sweep = G.sweep_k(vectors, 2, 5, restarts=3).orderBy("k").collect()
    assert [r.k for r in sweep if r.best] == [4]
    assert sweep[0].inertia > sweep[1].inertia > sweep[2].inertia


def test_silhouette_matches_all_pairs(spark, blobs):
    pdf, df = blobs
    x, labels = pdf[["a", "b", "c"]].to_numpy(), pdf.truth.to_numpy()
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    widths = []
    for i in range(len(x)):
        means = [d[i, labels == c].sum() / ((labels == c).sum() - (labels[i] == c)) for c in range(4)]
        a, b = means[labels[i]], min(m for c, m in enumerate(means) if c != labels[i])
        widths.append((b - a) / max(a, b))
    got = G.silhouette(df, ["a", "b", "c"], "truth").toPandas().set_index("truth").silhouette
    for c in range(4):
        assert got[c] == pytest.approx(np.array(widths)[labels == c].mean())
    from pyspark.ml.evaluation import ClusteringEvaluator

    judged = ClusteringEvaluator(predictionCol="truth").evaluate(G.to_vectors(df, ["a", "b", "c"]))
    assert judged == pytest.approx(np.mean(widths))


def test_principal_axes(spark, blobs):
    pdf, df = blobs
    got = G.principal_axes(df, "id", ["a", "b", "c"]).toPandas().set_index("id")
    z = (pdf[["a", "b", "c"]] - pdf[["a", "b", "c"]].mean()) / pdf[["a", "b", "c"]].std(ddof=0)
    _, s, vt = np.linalg.svd(z.to_numpy(), full_matrices=False)
    for j in range(2):
        v = vt[j] * np.sign(vt[j][np.abs(vt[j]).argmax()])
        assert np.allclose(got.loc[pdf.id, f"pca_{j + 1}"], z.to_numpy() @ v, atol=1e-6)
        assert got[f"explained_{j + 1}"].iloc[0] == pytest.approx((s**2 / (s**2).sum())[j])


def test_naming_is_greedy(spark):
    rows = [(0, 10.0, 0.1, 50.0, 3.0), (1, 90.0, 0.8, 99.0, 9.0), (2, 20.0, 0.2, 70.0, 8.0), (3, 30.0, 0.3, 60.0, 9.0)]
    means = spark.createDataFrame(rows, "cluster int, days_since_last_purchase double, churn_rate double, avg_order_value double, engagement_score double")
    got = {r.cluster: r.segment for r in G.name_segments(means).collect()}
    assert got == {1: "at_risk", 2: "high_value", 3: "loyal", 0: "price_hunter"}


def test_scaling_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    rows = G.apply_scaling(df, G.fit_scaling(df, ["a", "b"])).collect()
    assert [(r.a, r.b) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


def test_classifiers_find_a_planted_signal(spark, blobs):
    _, df = blobs
    rows, balanced = C.training_rows(df, ["a", "b", "c"], "y", "id")
    sizes = [r["count"] for r in balanced.groupBy("y").count().collect()]
    assert sizes[0] == sizes[1]
    test = rows.where("split = 'test'")
    for fitted in (C.fit_logistic(balanced, ["a", "b", "c"], "y"), C.fit_boosted(balanced, ["a", "b", "c"], "y", rounds=5)):
        scored = fitted.score(test)
        row = E.binary_metrics(scored, "y", "predicted", "raw_score", fitted.name).first()
        assert row.roc_auc > 0.95 and row.recall > 0.9
        top = C.importances(fitted, spark).first()
        assert top.feature == "a"
    stored = C.score_customers(fitted, rows, "id")
    assert stored.count() == 800 and set(stored.columns) == {"id", "churn_score", "churn_predicted", "risk_tier", "split"}


def test_logistic_penalty_matches_the_total_loss(spark):
    """The optimum of C * sum(loss) + |w|^2 / 2, found here by Newton steps."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + rng.normal(size=300) > 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y}))
    model = C.fit_logistic(df, ["a", "b"], "y", inverse_penalty=0.1).model
    z = np.c_[(x - x.mean(0)) / x.std(0), np.ones(300)]
    w, ridge = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(0.1 * (z.T * (p * (1 - p))) @ z + ridge, 0.1 * z.T @ (p - y) + ridge @ w)
    assert np.allclose([*model.coefficients, model.intercept], w, atol=1e-3)


@pytest.mark.parametrize("max_rows", [20, 20_000])
def test_curve_and_area(spark, max_rows):
    rng = np.random.default_rng(4)
    s = rng.random(400).round(2)
    y = (rng.random(400) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    wins = (s[y == 1][:, None] > s[y == 0]).mean() + (s[y == 1][:, None] == s[y == 0]).mean() / 2
    assert E.roc_auc(df, "y", "s", max_rows).first()[0] == pytest.approx(wins)
    points = E.roc_points(df, "y", "s", max_rows).orderBy(F.desc("threshold")).toPandas()
    for r in points.itertuples():
        assert r.tp == ((s >= r.threshold) & (y == 1)).sum() and r.fp == ((s >= r.threshold) & (y == 0)).sum()
    area = np.trapezoid([0, *points.tpr], [0, *points.fpr])
    assert area == pytest.approx(wins)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "y int, p int, s double")
    row = E.binary_metrics(df, "y", "p", "s", "m").first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.roc_auc) == (1.0, 0.0, 0.0, 0.0, None)
    report = {r["class"]: r for r in E.class_report(df, "y", "p").collect()}
    assert report["0"].f1 == 1.0 and report["1"].support == 0 and report["macro avg"].f1 == 0.5
    assert [tuple(r) for r in E.confusion_matrix(df, "y", "p").collect()] == [(0, 2, 0), (1, 0, 0)]


def test_axis_signs_do_not_depend_on_partitions(spark):
    """Two opposite columns load one axis equally: the first of them is positive, however the rows are dealt."""
    draw = random.Random(3)
    rows = [(i, x := draw.random(), 10.0 * (1 - x), draw.random()) for i in range(300)]
    frame = spark.createDataFrame(rows, "id int, a double, b double, c double")
    seen = set()
    for parts in (1, 2, 8, 34):
        got = G.principal_axes(frame.repartition(parts), "id", ["a", "b", "c"]).orderBy("id").collect()
        seen.add(tuple(round(r.pca_1, 6) for r in got))
    assert len(seen) == 1
    first = min(rows, key=lambda r: r[1])[0]
    assert next(iter(seen))[first] < 0


def planted(spark, n=600):
    draw = random.Random(11)
    rows = []
    for i in range(n):
        a, b, c = draw.random(), draw.randrange(5), draw.random() if i % 9 else None
        rows.append((str(i), a, b, c, int((a > 0.6) != (b >= 3)) if draw.random() < 0.95 else 1))
    return spark.createDataFrame(rows, "customer_id string, a double, b int, c double, churned int")


def test_newton_trees_learn_and_rescore(spark):
    frame, few = planted(spark), ["a", "b", "c"]
    losses = []
    for rounds in (1, 20, 60):
        model = W.fit_newton(frame.repartition(3), few, settings=W.Settings(rounds=rounds, step=0.3))
        scored = model.score(frame)
        losses.append(scored.agg(W.log_loss(scored)).first()[0])
    share = frame.agg(F.avg("churned")).first()[0]
    assert -share * np.log(share) - (1 - share) * np.log(1 - share) > losses[0] > losses[1] > losses[2]
    table = model.node_table(spark)
    again = {r.customer_id: r.raw_score for r in W.margin_from_table(frame, table).collect()}
    assert all(abs(again[r.customer_id] - r.raw_score) < 1e-9 for r in scored.collect()) and len(again) == 600
    gains = {r.feature: r.importance for r in model.importances(spark).collect()}
    total = table.agg(F.sum("gain")).first()[0]
    assert gains["a"] == pytest.approx(table.where("feature = 'a'").agg(F.sum("gain")).first()[0] / total)
    assert sum(gains.values()) == pytest.approx(1) and gains["a"] > gains["c"]


def test_newton_draws_do_not_depend_on_partitions(spark, monkeypatch):
    frame, s = planted(spark, 300), W.Settings(rounds=4)
    one = W.fit_newton(frame.repartition(1), ["a", "b", "c"], settings=s).rows()
    monkeypatch.setattr(W, "ROWS_PER_TASK", 50)
    many = W.fit_newton(frame.repartition(7), ["a", "b", "c"], settings=s).rows()
    assert [r[:4] for r in one] == [r[:4] for r in many]
    marks = np.arange(20_000, dtype=np.int64) * 7919
    assert abs(W.drawn_rows(marks, 3, 0.8, 42).mean() - 0.8) < 0.02
    assert (W.drawn_rows(marks, 3, 0.8, 42) != W.drawn_rows(marks, 4, 0.8, 42)).any()


def test_newton_on_one_class_and_no_rows(spark):
    frame = planted(spark, 50).withColumn("churned", F.lit(0))
    assert W.fit_newton(frame, ["a"], settings=W.Settings(rounds=3)).score(frame).agg(F.max("raw_score")).first()[0] < 0.5
    none = W.fit_newton(frame.limit(0), ["a"])
    assert none.trees == [] and {r.raw_score for r in none.score(frame).collect()} == {0.5}


@pytest.fixture(scope="module")
def gaps(spark, blobs):
    """The blobs, where every fifth row lacks one or two of its measures."""
    pdf = blobs[0].copy()
    lacks = lambda i, j: i % 5 == 0 and (j == i // 5 % 3 or (j == 2 and i % 10 == 0))
    rows = [
        (*(None if lacks(i, j) else float(r[c]) for j, c in enumerate("abc")), r["id"], int(r["y"]))
        for i, r in enumerate(pdf.to_dict("records"))
    ]
    return spark.createDataFrame(rows, "a double, b double, c double, id string, y int")


def filled(frame):
    """As a matrix, the mean in place of what is missing."""
    x = frame.select("a", "b", "c").toPandas().to_numpy(float)
    return np.where(np.isnan(x), np.nanmean(x, axis=0), x)


def test_importances_with_missing_features(spark, gaps):
    few = ["a", "b", "c"]
    for fitted in (C.fit_boosted(gaps, few, "y", rounds=3), C.fit_logistic(gaps, few, "y")):
        got = C.importances(fitted, spark).collect()
        assert got[0].feature == "a" and len(got) == 3


def test_boosted_scores_with_missing_features(spark, gaps):
    """A missing feature lies below every threshold: as if it were less than all others."""
    few = ["a", "b", "c"]
    low = gaps.fillna(-1000.0, few)
    got = {r.id: r.raw_score for r in C.fit_boosted(gaps, few, "y", rounds=5).score(gaps).collect()}
    assert len(got) == 800
    again = {r.id: r.raw_score for r in C.fit_boosted(low, few, "y", rounds=5).score(low).collect()}
    assert all(got[i] == pytest.approx(again[i]) for i in got)


def test_boosted_tiers_with_missing_features(spark, gaps):
    model = C.fit_boosted(gaps, ["a", "b", "c"], "y", rounds=3)
    scored = C.score_customers(model, gaps, "id")
    assert scored.where("churn_score between 0 and 1 and risk_tier is not null").count() == 800 and model.model.getNumTrees == 3


def test_sweep_of_rows_that_lack_measures(spark, gaps):
    scaling = G.fit_scaling(gaps, ["a", "b", "c"], filled=True)
    swept = G.sweep_k(G.to_vectors(gaps, ["a", "b", "c"], scaling).select("features"), 2, 4, restarts=2).orderBy("k").collect()
    assert 3 * 800 > swept[0].inertia > swept[1].inertia > swept[2].inertia and sum(r.best for r in swept) == 1


def test_a_null_needs_a_place(spark, gaps):
    with pytest.raises(Exception, match="VectorAssembler|null"):
        G.to_vectors(gaps, ["a", "b", "c"]).select("features").collect()


def test_squares_of_rows_that_lack_measures(spark, gaps):
    """Scaled with the mean in place of nulls, every column has as many squares as rows."""
    few = ["a", "b", "c"]
    scaled = G.apply_scaling(gaps, G.fit_scaling(gaps, few, filled=True)).fillna(0.0, few)
    assert scaled.agg(*[F.sum(F.col(c) ** 2).alias(c) for c in few]).first() == pytest.approx((800.0, 800.0, 800.0))


def test_clusters_of_rows_that_lack_measures(spark, gaps):
    out = G.assign_clusters(gaps, ["a", "b", "c"], 4, restarts=3)
    rows = out.collect()
    assert len(rows) == 800 and sum(r.c is None for r in rows) == gaps.where("c is null").count()
    x = filled(gaps)
    z = (x - x.mean(0)) / x.std(0)
    at = dict(zip([r.id for r in gaps.collect()], z, strict=True))
    label = np.array([r.cluster for r in rows])
    z = np.array([at[r.id] for r in rows])
    means = np.array([z[label == k].mean(0) for k in range(4)])
    assert (((z[:, None] - means) ** 2).sum(2).argmin(1) == label).mean() > 0.99


def test_check_of_clusters_holds_rows_that_lack_measures(spark, monkeypatch):
    """A cluster that such a customer is far from is misplaced; one customer is in the wrong cluster on purpose."""
    from tallyhouse.labels import SEGMENT_FEATURES
    from tallyhouse.plans import segment_queries as Q

    rows = [(str(i), *[float(i % 4 * 10 + i % 3) + c for c in range(10)]) for i in range(200)]
    rows += [("200", None, *rows[0][2:])]
    frame = spark.createDataFrame(rows, "customer_id string, " + ", ".join(f"{c} double" for c in SEGMENT_FEATURES))
    monkeypatch.setattr(Q, "customer_table", lambda *_: frame)
    assert Q.kmeans_check(spark, "").first() == (201, 0, 0)
    wrong = F.when(F.col("customer_id") == "200", 3).otherwise(F.col("customer_id").cast("int") % 4)
    monkeypatch.setattr(G, "assign_clusters", lambda df, **_: df.withColumn("cluster", wrong))
    assert Q.kmeans_check(spark, "").first() == (201, 0, 1)


def test_logistic_fits_every_row(spark, gaps):
    """The gradient over all rows vanishes, those that lack measures included."""
    few = ["a", "b", "c"]
    fitted = C.fit_logistic(gaps, few, "y")
    x = filled(gaps)
    z = (x - x.mean(0)) / x.std(0)
    assert all(fitted.scaling[c] == pytest.approx((x[:, j].mean(), x[:, j].std())) for j, c in enumerate(few))
    miss = np.array([r.raw_score - r.y for r in fitted.score(gaps).collect()])
    assert len(miss) == 800 and abs(z.T @ miss + fitted.model.coefficients.toArray()).max() / 800 < 1e-4


def test_logistic_scores_with_missing_features(spark, gaps):
    """A missing feature is the mean."""
    few = ["a", "b", "c"]
    whole = pd.DataFrame(filled(gaps), columns=few)
    whole[["id", "y"]] = gaps.select("id", "y").toPandas()
    want = {r.id: r.raw_score for r in C.fit_logistic(spark.createDataFrame(whole), few, "y").score(spark.createDataFrame(whole)).collect()}
    got = {r.id: r.raw_score for r in C.fit_logistic(gaps, few, "y").score(gaps).collect()}
    assert len(got) == 800 and all(got[i] == pytest.approx(want[i], abs=1e-4) for i in want)


def test_axes_of_rows_that_lack_measures(spark, gaps):
    """As the SQL twin: covariances over the rows that have both, a missing measure adds nothing."""
    got = G.principal_axes(gaps, "id", ["a", "b", "c"]).toPandas().set_index("id")
    pdf = gaps.toPandas()
    z = (pdf[["a", "b", "c"]] - pdf[["a", "b", "c"]].mean()) / pdf[["a", "b", "c"]].std(ddof=0)
    x = z.to_numpy(float)
    cov = np.array([[np.nanmean(x[:, i] * x[:, j]) for j in range(3)] for i in range(3)])
    value, axis = np.linalg.eigh(cov)
    for j in range(2):
        v = axis[:, -1 - j] * np.sign(axis[np.abs(axis[:, -1 - j]).argmax(), -1 - j])
        assert np.allclose(got.loc[pdf.id, f"pca_{j + 1}"], np.nan_to_num(x) @ v, atol=1e-6)
        assert got[f"explained_{j + 1}"].iloc[0] == pytest.approx(value[-1 - j] / 3)


def test_newton_tasks_follow_the_cores():
    """A task a core, not one for every 50,000 rows; beyond the most rows a task may hold, the cores several times."""
    assert [W._tasks(n, 6) for n in (0, 1, 50_001, 299_999, 1_000_000, 7_000_000, 12_000_001)] == [1, 1, 2, 6, 6, 6, 12]


def test_newton_jobs_and_blocks(spark, monkeypatch):
    """Blocks of 20 rows, one task a core: a job a level and no other, also where margins are brought up to date."""
    frame, s = planted(spark, 300), W.Settings(rounds=2 * W.REFRESH + 2, depth=2)
    one = W.fit_newton(frame, ["a", "b", "c"], settings=s).rows()
    monkeypatch.setattr(W, "ROWS_PER_TASK", 20)
    context, grow, tasks = spark.sparkContext, W._grow, set()

    def counted(parts, *given):
        context.setJobGroup("levels", "")  # what runs from the first tree on
        tasks.add(parts.getNumPartitions())
        grow(parts, *given)

    monkeypatch.setattr(W, "_grow", counted)
    try:
        many = W.fit_newton(frame, ["a", "b", "c"], settings=s).rows()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert [r[:4] for r in many] == [r[:4] for r in one]
    assert tasks == {min(15, context.defaultParallelism)}
    assert len(context.statusTracker().getJobIdsForGroup("levels")) == s.depth * s.rounds


def test_newton_walks_agree():
    """Trees of few and of many nodes are walked in two ways."""
    draw = np.random.default_rng(5)
    binned = np.asfortranarray(draw.integers(0, 64, (500, 4), dtype=np.uint8))
    tree, far = {}, {}
    for n in range(1, 64):
        inner = n < 32 and (n == 1 or tree[n // 2][0] >= 0) and draw.random() < 0.9
        if n == 1 or (n // 2 in tree and tree[n // 2][0] >= 0):
            tree[n] = (int(draw.integers(4)), int(draw.integers(63)), 1.0, 1.0, 0.0) if inner else (-1, -1, 0.0, 1.0, draw.random())
    far = tree | {200: (-1, -1, 0.0, 1.0, 0.0)}  # nobody gets there
    for levels in range(7):
        assert (W.landed(tree, binned, levels) == W.landed(far, binned, levels)).all()
    assert (W.leaf_values(tree, binned) == W.leaf_values(far, binned)).all()
