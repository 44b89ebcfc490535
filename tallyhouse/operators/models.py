"""Stored classifiers: a folder with the model and all that scoring new rows needs."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.labels import TIER_EDGES, TIER_LABELS
from tallyhouse.operators.classify import Classifier
from tallyhouse.operators.newton import NewtonTrees
from tallyhouse.sources import versions

VERSION = 1
NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def save_model(model: Classifier | NewtonTrees, train: DataFrame, path: str, label: str = "churned") -> None:
    """Write a fitted model: its parameters, features with their types, scaling, tier edges, and counts of what it was fitted on.

    The description is switched last (see ``versions``), so a reader never sees a half-written model.
    """
    spark = train.sparkSession
    types = dict(train.dtypes)
    counts = {str(r[0]): r[1] for r in train.groupBy(label).agg(F.count(F.lit(1))).collect()}
    meta = {
        "version": VERSION, "features": model.features, "types": [types[c] for c in model.features], "label": label, "fitted_on": counts,
        "tier_edges": list(TIER_EDGES), "tier_labels": list(TIER_LABELS), "scaling": None, "folder": None, "edges": None,
    }
    if isinstance(model, NewtonTrees):
        meta |= {"kind": "newton", "edges": [e.tolist() for e in model.edges], "trees": [[[n, *t] for n, t in sorted(tree.items())] for tree in model.trees]}
    else:
        kind = "logistic" if isinstance(model.model, LogisticRegressionModel) else "boosted"
        folder = f"{path}/ml-{model.model.uid}-{abs(hash(json.dumps(counts))):x}"
        model.model.write().overwrite().save(folder)
        meta |= {"kind": kind, "scaling": model.scaling, "folder": folder}
    versions.replace(spark.createDataFrame([(json.dumps(meta),)], "meta string"), path)


def load_model(spark: SparkSession, path: str, rows: DataFrame | None = None) -> Classifier | NewtonTrees:
    """Read a stored model. ``rows`` are checked if given: a feature that is absent or of another kind of type is refused."""
    meta = json.loads(versions.current(spark, path).first()[0])
    if meta["version"] != VERSION or (meta["tier_edges"], meta["tier_labels"]) != (list(TIER_EDGES), list(TIER_LABELS)):
        raise ValueError(f"the model in {path} was stored for other tiers or by another version")
    if rows is not None:
        check_rows(meta, rows)
    if meta["kind"] == "newton":
        trees = [{int(n): (int(f), int(c), g, h, v) for n, f, c, g, h, v in tree} for tree in meta["trees"]]
        return NewtonTrees(meta["features"], [np.array(e, float) for e in meta["edges"]], trees)
    kind = LogisticRegressionModel if meta["kind"] == "logistic" else GBTClassificationModel
    scaling = {c: tuple(x) for c, x in meta["scaling"].items()} if meta["scaling"] else None
    return Classifier(meta["kind"], kind.load(meta["folder"]), meta["features"], scaling)


def check_rows(meta: dict, rows: DataFrame) -> None:
    types = dict(rows.dtypes)
    absent = [c for c in meta["features"] if c not in types]
    other = [c for c, t in zip(meta["features"], meta["types"], strict=True) if c in types and (types[c] in NUMERIC) != (t in NUMERIC)]
    if absent or other:
        raise ValueError(f"the rows do not fit the model: absent {absent}, of another type {other}")
