"""Versioned tables, stored models, anchor silhouettes."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import classify as C, models, newton as W, silhouettes
from tallyhouse.sources import versions


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def content(spark, path):
    return sorted(r.v for r in versions.current(spark, path).collect())


def test_failed_write_or_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, path)
    assert versions.replace(numbers(spark, 1, 2), path) == 2
    begun = versions.current(spark, path)

    broken = numbers(spark, 7, 8).select(F.when(F.col("v") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        versions.replace(broken, path)
    assert content(spark, path) == [1, 2]

    def fail(*_):
        raise OSError("stopped before the switch")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_switch", fail)
        with pytest.raises(OSError):
            versions.replace(numbers(spark, 9), path)
    assert content(spark, path) == [1, 2]

    # a table may be replaced from its own rows, and a reader that has begun keeps its version
    assert versions.replace(versions.current(spark, path).select((F.col("v") * 10).alias("v")), path) == 2
    assert content(spark, path) == [10, 20] and sorted(r.v for r in begun.collect()) == [1, 2]
    assert len(versions.vacuum(spark, path)) >= 2 and content(spark, path) == [10, 20]
    assert versions.vacuum(spark, path) == []


def test_repeated_append_adds_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert versions.append_once(numbers(spark, 1), path, "monday") == 1
    assert versions.append_once(numbers(spark, 2, 3), path, "tuesday") == 2
    assert versions.append_once(numbers(spark, 2, 3), path, "tuesday") == 0
    assert content(spark, path) == [1, 2, 3]
    # a job that stopped after its write and is run again adds its rows once
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_switch", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            versions.append_once(numbers(spark, 4), path, "wednesday")
    assert versions.append_once(numbers(spark, 4), path, "wednesday") == 1
    assert content(spark, path) == [1, 2, 3, 4]
    assert versions.manifest(spark, path)["loads"] == ["monday", "tuesday", "wednesday"]


def customers(spark):
    draw = random.Random(4)
    rows = [(str(i), x := draw.random(), draw.randrange(9), int(x + draw.random() > 1)) for i in range(200)]
    return spark.createDataFrame(rows, "customer_id string, a double, b int, churned int")


@pytest.mark.parametrize("kind", ["logistic", "boosted", "newton"])
def test_second_session_scores_with_a_stored_model(spark, tmp_path, kind):
    train, few, path = customers(spark), ["a", "b"], str(tmp_path / "model")
    fit = {
        "logistic": lambda: C.fit_logistic(train, few),
        "boosted": lambda: C.fit_boosted(train, few, rounds=3),
        "newton": lambda: W.fit_newton(train, few, settings=W.Settings(rounds=5)),
    }[kind]
    model = fit()
    want = {tuple(r) for r in C.score_customers(model, train).collect()}
    models.save_model(model, train, path)

    other = spark.newSession()
    fresh = other.createDataFrame(train.toPandas(), train.schema)
    loaded = models.load_model(other, path, fresh)
    assert {tuple(r) for r in C.score_customers(loaded, fresh).collect()} == want
    with pytest.raises(ValueError, match="absent \\['b'\\]"):
        models.load_model(other, path, fresh.drop("b"))
    with pytest.raises(ValueError, match="another type \\['a'\\]"):
        models.load_model(other, path, fresh.withColumn("a", F.lit("x")))


def test_other_tiers_are_refused(spark, tmp_path, monkeypatch):
    train, path = customers(spark), str(tmp_path / "model")
    models.save_model(W.fit_newton(train, ["a"], settings=W.Settings(rounds=1)), train, path)
    monkeypatch.setattr(models, "TIER_EDGES", (0.0, 0.5, 1.0))
    with pytest.raises(ValueError, match="tiers"):
        models.load_model(spark, path)


def test_silhouette_with_all_rows_as_anchors(spark):
    draw = np.random.default_rng(2)
    label = np.array([0] * 30 + [1] * 50 + [2])
    x = draw.normal(size=(81, 3)) + label[:, None]
    frame = spark.createDataFrame([(str(i), int(c), *map(float, p)) for i, (c, p) in enumerate(zip(label, x, strict=True))], "id string, c int, x double, y double, z double")
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = {}
    for i, c in enumerate(label):
        own = far[i, label == c].sum() / max((label == c).sum() - 1, 1)
        other = min(far[i, label == d].mean() for d in set(label.tolist()) - {c})
        want.setdefault(int(c), []).append((other - own) / max(own, other) if (label == c).sum() > 1 else 0.0)
    got = {r.c: r for r in silhouettes.silhouette_exact(frame.repartition(5), ["x", "y", "z"], "c", "id", 1000).collect()}
    assert {c: got[c].n for c in got} == {0: 30, 1: 50, 2: 1}
    assert all(got[c].silhouette == pytest.approx(np.mean(v)) for c, v in want.items())
    some = silhouettes.silhouette_exact(frame, ["x", "y", "z"], "c", "id", 30).collect()
    assert sorted(r.n for r in some) == [1, 10, 10]
    alone = silhouettes.silhouette_exact(frame.where("c = 0"), ["x"], "c", "id", 5).collect()
    assert [r.silhouette for r in alone] == [None]
