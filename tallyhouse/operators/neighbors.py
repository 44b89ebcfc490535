"""Exact nearest neighbours and minority oversampling.

Points are ordered along their widest feature and cut into slabs of equal row count.
A coordinate difference never exceeds the Euclidean distance, so a slab farther away
along that axis than the k-th distance found so far cannot hold a closer point. Blocks
of one slab against another are compared inside tasks and give at most k rows per
point; the search widens, for unresolved points only, until every answer is proven.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.config import SMALL_ROWS, settle
from tallyhouse.functions.expressions import hash_key, hash_unit
from tallyhouse.operators.ranking import number_rows

COPIES_PER_CHUNK = 1000


def _closest(k: int):
    """Compare one block of query points with one block of targets as a matrix of distances."""

    def compare(query: pd.DataFrame, target: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"id": [], "neighbor": [], "distance": []})
        if not len(query) or not len(target):
            return empty.astype({"id": "object", "neighbor": "object", "distance": "float64"})
        target = target.sort_values("neighbor", kind="stable")
        q, t = np.stack(query["x"].to_numpy()), np.stack(target["point"].to_numpy())
        own, names = query["id"].to_numpy(), target["neighbor"].to_numpy()
        d = np.sqrt(((q[:, None, :] - t[None, :, :]) ** 2).sum(axis=2))
        d[own[:, None] == names[None, :]] = np.inf
        d[d > query["radius"].to_numpy()[:, None]] = np.inf
        best = np.argsort(d, axis=1, kind="stable")[:, :k]
        near = np.take_along_axis(d, best, 1)
        rows, places = np.nonzero(np.isfinite(near))
        return pd.DataFrame({"id": own[rows], "neighbor": names[best[rows, places]], "distance": near[rows, places]})

    return compare


def nearest_neighbors(
    df: DataFrame,
    identity: str,
    features: Sequence[str],
    k: int = 5,
    slab_rows: int = 512,
    max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """``id, neighbor, distance, rank``: the k nearest other rows of each row by (distance, id).

    The ids must be unique. Rows with equal features are one point of the search, of which
    the k + 1 smallest ids are kept (pruned before the shuffle); a point's answer is shared by its rows, each
    leaving itself out. So many copies of a point cost no more than one, and ties do not
    depend on how the points are cut into slabs.
    """
    rows = df.select(
        F.col(identity).cast("string").alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    )
    place = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    few = (
        rows.withColumn("_place", place)
        .where(F.col("_place") <= k + 1)
        .groupBy("x")
        .agg(F.min("id").alias("point"), F.array_sort(F.collect_list("id")).alias("ids"))
    )
    few = settle(few, max_rows, heavy=True)
    found = _nearest_points(few.select(F.col("point").alias("id"), "x"), features, k, slab_rows, max_rows)
    around = found.select("id", "distance", F.col("neighbor").alias("point")).join(few.select("point", "ids"), "point")
    same = few.select(F.col("point").alias("id"), F.lit(0.0).alias("distance"), "ids")
    near = around.select("id", "distance", "ids").unionByName(same)
    near = near.select("id", F.explode(F.transform("ids", lambda n: F.struct(F.col("distance"), n.alias("neighbor")))).alias("near"))
    nearest = F.slice(F.array_sort(F.collect_list("near")), 1, k + 1)  # of at most k * k + 2 k + 1 rows
    answers = near.groupBy(F.col("id").alias("point")).agg(nearest.alias("near"))
    own = rows.join(few.select("x", "point"), "x").select("id", "point").join(answers, "point")
    others = F.slice(F.filter("near", lambda n: n["neighbor"] != F.col("id")), 1, k)
    ranked = own.select("id", F.posexplode(others).alias("place", "near"))
    return ranked.select("id", "near.neighbor", "near.distance", (F.col("place") + 1).alias("rank"))


def _nearest_points(
    distinct: DataFrame, features: Sequence[str], k: int, slab_rows: int, max_rows: int
) -> DataFrame:
    """The same for points (``id``, ``x``) of which no two are equal."""
    spread = distinct.agg(*[F.coalesce(F.var_pop(F.col("x")[i]), F.lit(0.0)) for i in range(len(features))]).first()
    axis = max(range(len(features)), key=lambda i: spread[i])
    points = distinct.withColumn("axis", F.col("x")[axis])
    numbered = number_rows(points, ["axis", "id"], "place", max_rows)
    slab = F.expr(f"(place - 1) div {slab_rows}").alias("slab")
    points = settle(numbered.select("id", "x", "axis", slab), max_rows, heavy=True)
    bounds = settle(points.groupBy("slab").agg(F.min("axis").alias("lo"), F.max("axis").alias("hi")), max_rows)
    last_slab = bounds.agg(F.max("slab")).first()[0]
    open_points = points.withColumn("radius", F.lit(float("inf")))
    best = None
    fresh = F.array(F.lit(-1), F.lit(0), F.lit(1))
    reach = 1
    by_id = Window.partitionBy("id").orderBy("distance", "neighbor")
    while True:
        source = open_points.groupBy("slab").agg(
            F.max("radius").alias("radius"), F.min("axis").alias("from"), F.max("axis").alias("to")
        )
        pairs = (
            source.select("*", F.explode(fresh).alias("offset"))
            .withColumn("target", F.col("slab") + F.col("offset"))
            .join(bounds.withColumnRenamed("slab", "target"), "target")
            .where((F.col("lo") <= F.col("to") + F.col("radius")) & (F.col("hi") >= F.col("from") - F.col("radius")))
            .select("slab", "target")
        )
        pairs = settle(pairs, max_rows)
        query = open_points.select("slab", "id", "x", "radius").join(pairs, "slab")
        target = points.select(
            F.col("slab").alias("target"), F.col("id").alias("neighbor"), F.col("x").alias("point")
        ).join(pairs.withColumnRenamed("slab", "from_slab"), "target")
        found = (
            query.groupBy("slab", "target")
            .cogroup(target.groupBy("from_slab", "target"))
            .applyInPandas(_closest(k), "id string, neighbor string, distance double")
        )
        if best is not None:
            found = best.select("id", "neighbor", "distance").unionByName(found)
        ranked = found.withColumn("rank", F.row_number().over(by_id))
        best = settle(ranked.where(F.col("rank") <= k), max_rows, heavy=True)
        if last_slab is None or reach >= last_slab:
            return best
        kth = best.where(F.col("rank") == k).select("id", F.col("distance").alias("radius"))
        left = bounds.select((F.col("slab") + reach + 1).alias("slab"), F.col("hi").alias("left_edge"))
        right = bounds.select((F.col("slab") - reach - 1).alias("slab"), F.col("lo").alias("right_edge"))
        open_points = settle(
            points.join(kth, "id", "left")
            .withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
            .join(left, "slab", "left")
            .join(right, "slab", "left")
            .where(
                (F.col("axis") - F.col("left_edge") <= F.col("radius"))
                | (F.col("right_edge") - F.col("axis") <= F.col("radius"))
            )
            .select("id", "x", "axis", "slab", "radius"),
            max_rows,
            heavy=True,
        )
        if open_points.isEmpty():
            return best
        wider = min(2 * reach + 1, last_slab)
        fresh = F.concat(
            F.sequence(F.lit(-wider), F.lit(-reach - 1)), F.sequence(F.lit(reach + 1), F.lit(wider))
        )
        reach = wider


def oversample_minority(
    df: DataFrame,
    label: str,
    identity: str,
    features: Sequence[str],
    minority: int = 1,
    k: int = 5,
    seed: int = 42,
    slab_rows: int = 512,
) -> DataFrame:
    """Raise the minority class to the size of the rest with interpolated rows.

    Base rows get equal numbers of synthetic rows (the remainder goes to the smallest
    hashes); each lies at a hashed fraction of the way to a hashed one of the k nearest
    minority rows. Columns keep their types, so whole-number features are truncated.
    Adds ``synthetic`` (0/1); synthetic ids are ``<base>#<number>``.
    """
    real = df.select(F.col(identity).cast("string").alias(identity), *features, label)
    rare = real.where(F.col(label) == minority)
    sizes = df.agg(
        F.count_if(F.col(label) == minority).alias("rare"), F.count_if(F.col(label) != minority).alias("rest")
    ).first()
    original = real.withColumn("synthetic", F.lit(0))
    deficit = sizes["rest"] - sizes["rare"]
    if deficit <= 0 or sizes["rare"] == 0:
        return original
    each, extra = divmod(deficit, sizes["rare"])
    types = {f.name: f.dataType for f in real.schema.fields}
    near = nearest_neighbors(rare, identity, features, k, slab_rows)
    place = F.struct(*[F.col(c).cast("double").alias(c) for c in features])
    # At most k neighbours per base row, gathered with their values before any copy is made.
    around = (
        near.join(rare.select(F.col(identity).alias("neighbor"), place.alias("there")), "neighbor")
        .groupBy(F.col("id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", "there"))).alias("around"))
    )
    hashed = rare.select(F.col(identity).alias("base"), hash_key(F.col(identity), seed).alias("_hash"))
    copies = F.lit(each) + (F.col("_place") <= extra).cast("int")
    based = (
        number_rows(hashed, ["_hash", "base"], "_place")
        .select("base", copies.cast("int").alias("copies"))
        .where("copies > 0")
        .join(rare.select(F.col(identity).alias("base"), place.alias("here")), "base")
        .join(around, "base", "left")
    )
    # A small minority means many copies per base row: deal them out in chunks.
    first = F.col("chunk") * COPIES_PER_CHUNK
    last = F.least(F.col("copies"), first + COPIES_PER_CHUNK)
    last_chunk = F.expr(f"(copies - 1) div {COPIES_PER_CHUNK}").cast("int")
    made = (
        based.withColumn("chunk", F.explode(F.sequence(F.lit(0), last_chunk)))
        .repartition("base", "chunk")
        .withColumn("number", F.explode(F.sequence(first + 1, last)))
        .withColumn("token", F.concat_ws("#", "base", "number"))
        .withColumn("choice", F.pmod(hash_key(F.col("token"), seed + 1), F.size("around")).cast("int"))
        .withColumn("step", hash_unit(F.col("token"), seed + 2))
        .withColumn("there", F.coalesce(F.col("around")[F.col("choice")]["there"], F.col("here")))
    )
    between = [
        (F.col("here")[c] + F.col("step") * (F.col("there")[c] - F.col("here")[c])).cast(types[c]).alias(c)
        for c in features
    ]
    synthetic = made.select(
        F.col("token").alias(identity),
        *between,
        F.lit(minority).cast(types[label]).alias(label),
        F.lit(1).alias("synthetic"),
    )
    return original.unionByName(synthetic)
