"""Boosted trees of second order: histograms of gradient and hessian per partition, one job per level."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.storagelevel import StorageLevel

from tallyhouse.config import stored
from tallyhouse.labels import CHURN_FEATURES

# Thresholds per feature at most, and the accuracy of the quantiles they are taken from.
BINS, ACCURACY = 64, 100_000
# Rounds after which the margins of the rows are brought up to date and cached.
REFRESH = 5
# A task is worth starting for so many rows, which are also a block; it takes at most so many when the cores are too few.
ROWS_PER_TASK, MOST_ROWS = 50_000, 2_000_000
# Up to so many tasks the driver adds up their tables itself, which saves each level a second stage.
FEW_TASKS = 64

NODES = "tree int, node int, feature string, threshold double, `left` int, `right` int, gain double, cover double, value double"


@dataclass(frozen=True)
class Settings:
    """Draws are per tree: rows by a hash of their number, columns by a generator of the driver."""

    rounds: int = 300
    depth: int = 4
    step: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    penalty: float = 1.0
    least_gain: float = 0.0
    least_cover: float = 1.0
    seed: int = 42


@dataclass
class NewtonTrees:
    """Node tables of all trees; nodes of a tree are numbered from 1, the children of n are 2n and 2n + 1."""

    features: list[str]
    edges: list[np.ndarray]
    trees: list[dict] = field(default_factory=list)

    def rows(self) -> list[tuple]:
        """One tuple per node, as ``NODES`` names them; a leaf has a value and no feature."""
        out = []
        for t, tree in enumerate(self.trees):
            for node in sorted(tree):
                f, cut, gain, cover, value = tree[node]
                split = (None, None, None, None, 0.0) if f < 0 else (self.features[f], float(self.edges[f][cut]), 2 * node, 2 * node + 1, gain)
                out.append((t, node, *split, cover, value if f < 0 else None))
        return out

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), NODES)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``raw_score`` (probability of class 1) and ``predicted``; null features lie below every threshold."""
        model, names = self, list(df.columns)
        numbers = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(self.features)]
        schema = StructType([*df.schema.fields, StructField("raw_score", DoubleType())])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[len(names) :]], 1)
                binned = model.binned(x)
                margin = np.zeros(len(x))
                for tree in model.trees:
                    margin += leaf_values(tree, binned)
                p = 1.0 / (1.0 + np.exp(-margin))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(p)], schema.names)

        scored = df.select("*", *numbers).mapInArrow(score, schema)
        return scored.withColumn("predicted", (F.col("raw_score") > 0.5).cast("int"))

    def binned(self, x: np.ndarray) -> np.ndarray:
        """How many thresholds lie below each value."""
        out = np.zeros(x.shape, np.uint8, order="F")
        for f, edges in enumerate(self.edges):
            out[:, f] = np.searchsorted(edges, np.where(np.isnan(x[:, f]), -np.inf, x[:, f]), side="left")
        return out

    def part(self, batch: pa.RecordBatch, width: int) -> Part:
        """A block from its features, label and mark."""
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        x = np.stack([c.astype(float) for c in columns[:width]], 1)
        return Part(self.binned(x), columns[width].astype(float), columns[width + 1].astype(np.int64), np.zeros(len(x)))

    def importances(self, spark: SparkSession) -> DataFrame:
        """``feature, importance``: gains over all splits of a feature as a share of all gains; 0 without a split."""
        table = self.node_table(spark).where("feature is not null").groupBy("feature").agg(F.sum("gain").alias("gain"))
        every = spark.createDataFrame([(f,) for f in self.features], "feature string")
        whole = sum(r[6] for r in self.rows()) or 1.0
        shares = every.join(table, "feature", "left").select("feature", (F.coalesce("gain", F.lit(0.0)) / whole).alias("importance"))
        return shares.orderBy(F.desc("importance"), "feature")


def leaf_values(tree: dict, binned: np.ndarray) -> np.ndarray:
    at = landed(tree, binned, 30)
    size = max(tree) + 1
    values = np.zeros(size)
    for node, (f, _, _, _, value) in tree.items():
        if f < 0:
            values[node] = value
    return values[at]


def landed(tree: dict, binned: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after so many levels, or the leaf it stopped at."""
    if max(tree) < 128:
        return _landed_by_node(tree, binned, levels)
    at = np.ones(len(binned), np.int64)
    size = max(tree) + 1
    feature, cut = np.full(size, -1), np.zeros(size, np.int64)
    for node, (f, c, *_) in tree.items():
        feature[node], cut[node] = f, c
    rows = np.arange(len(binned))
    for _ in range(levels):
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            break
        down = 2 * at + (binned[rows, np.maximum(f, 0)] > cut[at])
        at = np.where(inner, down, at)
    return at


def _landed_by_node(tree: dict, binned: np.ndarray, levels: int) -> np.ndarray:
    """The same for trees of few nodes, node by node: bytes are compared and added without looking anything up per row."""
    at = np.ones(len(binned), np.uint8)
    for level in range(levels):
        inner = [n for n in tree if n >> level == 1 and tree[n][0] >= 0]
        if not inner:
            break
        step = np.zeros(len(binned), np.uint8)
        for n in inner:
            right = binned[:, tree[n][0]] > tree[n][1]
            step += (at == n).view(np.uint8) * (right.view(np.uint8) + np.uint8(n))
        at += step
    return at


def drawn_rows(marks: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Whether each row takes part in a tree: a hash of its mark, the tree and the seed."""
    if share >= 1:
        return np.ones(len(marks), bool)
    h = marks.view(np.uint64) ^ np.uint64((tree + 1) * 0x9E3779B97F4A7C15 + seed & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))) < np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))


@dataclass
class Part:
    """A block of rows: bins (column by column), labels, marks and the margins up to a round."""

    binned: np.ndarray
    label: np.ndarray
    marks: np.ndarray
    margin: np.ndarray


def thresholds(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Distinct quantiles of each feature, values of the data, from one pass of mergeable sketches; nulls are left out."""
    shares = [i / BINS for i in range(1, BINS)]
    asked = [F.percentile_approx(F.col(c).cast("double"), shares, ACCURACY).alias(c) for c in features]
    row = df.agg(*asked).first()
    return [np.unique(np.array(row[c] if row[c] is not None else [], float)) for c in features]


def fit_newton(
    train: DataFrame, features: Sequence[str] = tuple(CHURN_FEATURES), label: str = "churned", identity: str = "customer_id", settings: Settings = Settings()
) -> NewtonTrees:
    """Trees fitted to the logistic loss with the gain and the leaf weights of second order.

    Each level is one job: a task adds up gradients and hessians of its rows by node, feature and
    bin, and the tables of all tasks are summed, by the driver if there are up to ``FEW_TASKS``, else in a tree of tasks; a table
    has ``2 ** depth`` x features x bins, whatever the number of rows. There are as many tasks as cores, or more, so that a task holds
    ``MOST_ROWS`` rows at most; they are kept as bytes and read block by block, which bounds memory. Rows are drawn by a hash of
    ``identity``, so a task that is run again draws the same. Every ``REFRESH`` rounds the margins are brought up to
    date from the stored rows, which a lost executor recomputes; that happens in the job of the next level.
    """
    features = list(features)
    model = NewtonTrees(features, thresholds(train, features))
    rows = train.select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
        F.col(label).cast("double").alias("label"), F.xxhash64(identity).alias("mark"),
    )
    rows = stored(rows, "train")
    total = rows.count()
    tasks = _tasks(total, train.sparkSession.sparkContext.defaultParallelism)
    width, block = len(features), ROWS_PER_TASK
    bins = NewtonTrees(features, model.edges)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Part] = []
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                held.append(bins.part(batch.slice(start, block), width))
                if sum(len(p.label) for p in held) >= block:
                    yield _as_bytes(held)
                    held = []
        if held:
            yield _as_bytes(held)

    blocks = rows.repartition(tasks).mapInArrow(packed, "part binary").rdd
    parts: RDD = blocks.map(lambda row: pickle.loads(row[0])).persist(StorageLevel.MEMORY_AND_DISK)
    generator = np.random.default_rng(settings.seed)
    take = max(1, round(settings.columns * width))
    since: list[dict] = []
    depth = 1 if tasks <= FEW_TASKS else 2
    for t in range(settings.rounds if total else 0):
        before = None
        if len(since) >= REFRESH:
            before, parts, since = parts, _refreshed(parts, since), []
        columns = np.sort(generator.permutation(width)[:take]) if take < width else np.arange(width)
        tree: dict[int, tuple] = {}
        _grow(parts, model, tree, t, since, columns, settings, depth)
        if before is not None:
            before.unpersist()
        model.trees.append(tree)
        since.append(tree)
    parts.unpersist()
    return model


def _tasks(rows: int, cores: int) -> int:
    """One task a core, fewer if they had less than ``ROWS_PER_TASK`` rows, more (the cores several times) if more than ``MOST_ROWS``."""
    times = max(1, -(-rows // (MOST_ROWS * cores)))
    return max(1, min(-(-rows // ROWS_PER_TASK), times * cores))


def _as_bytes(parts: list[Part]) -> pa.RecordBatch:
    """Parts put together, as one value."""
    whole = parts[0]
    if len(parts) > 1:
        binned = np.asfortranarray(np.concatenate([p.binned for p in parts]))
        whole = Part(binned, *(np.concatenate([getattr(p, c) for p in parts]) for c in ("label", "marks", "margin")))
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(whole, pickle.HIGHEST_PROTOCOL)], pa.binary())], ["part"])


def _refreshed(parts: RDD, trees: list[dict]) -> RDD:
    """Parts with the values of these trees in their margins, kept once a job has read them."""
    trees = list(trees)

    def moved(part: Part) -> Part:
        return Part(part.binned, part.label, part.marks, part.margin + sum(leaf_values(t, part.binned) for t in trees))

    return parts.map(moved).persist(StorageLevel.MEMORY_AND_DISK)


def _grow(parts: RDD, model: NewtonTrees, tree: dict, number: int, since: list[dict], columns: np.ndarray, s: Settings, depth: int) -> None:
    """Fill ``tree`` level by level; a node stays a leaf where no split gains more than ``least_gain``.

    What a split sends to either side gives the sums of its children, so the last level needs no job.
    """
    live, known = [1], {}
    for level in range(s.depth + 1):
        if not live:
            return
        if level < s.depth:
            sums = parts.map(_histogram(dict(tree), live, number, list(since), columns, level, s)).treeReduce(np.add, depth)
        following = []
        for k, node in enumerate(live):
            g, h = known[node] if node in known else sums[k, 0].sum(0)
            best, sides = (s.least_gain, -1, -1), None
            # sums: node, feature, bin, (gradient, hessian)
            for j, f in enumerate(columns if level < s.depth else ()):
                left = sums[k, j, : len(model.edges[f])].cumsum(0)
                gl, hl = left[:, 0], left[:, 1]
                gain = 0.5 * (gl**2 / (hl + s.penalty) + (g - gl) ** 2 / (h - hl + s.penalty) - g**2 / (h + s.penalty))
                gain = np.where((hl >= s.least_cover) & (h - hl >= s.least_cover), gain, -np.inf)
                if len(gain) and gain.max() > best[0] + 1e-9:
                    cut = int(np.flatnonzero(gain >= gain.max() - 1e-9)[0])
                    best, sides = (float(gain[cut]), int(f), cut), ((gl[cut], hl[cut]), (g - gl[cut], h - hl[cut]))
            value = float(-s.step * g / (h + s.penalty))
            tree[node] = (best[1], best[2], best[0] if sides else 0.0, float(h), value)
            if sides:
                known[2 * node], known[2 * node + 1] = sides
                following += [2 * node, 2 * node + 1]
        live = following


def _histogram(tree: dict, live: list[int], number: int, since: list[dict], columns: np.ndarray, level: int, s: Settings):
    place = {node: k for k, node in enumerate(live)}

    def histogram(part: Part) -> np.ndarray:
        margin = part.margin + sum((leaf_values(t, part.binned) for t in since), 0.0)
        at = landed(tree, part.binned, level) if tree else np.ones(len(margin), np.int64)
        where = np.full(max(max(live), int(at.max())) + 1, -1)
        for node, k in place.items():
            where[node] = k
        slot = where[at]
        keep = np.flatnonzero((slot >= 0) & drawn_rows(part.marks, number, s.rows, s.seed))
        first = slot[keep] * BINS
        p = 1.0 / (1.0 + np.exp(-margin[keep]))
        g, h = p - part.label[keep], p * (1.0 - p)
        out = np.zeros((len(live), len(columns), BINS, 2))
        for j, f in enumerate(columns):
            index = first + part.binned[:, f][keep]
            for i, weight in enumerate((g, h)):
                out[:, j, :, i] = np.bincount(index, weight, minlength=len(live) * BINS).reshape(len(live), BINS)
        return out

    return histogram


def margin_from_table(customers: DataFrame, nodes: DataFrame, identity: str = "customer_id", depth: int = 4) -> DataFrame:
    """``identity`` and ``raw_score`` from a node table by joins alone: one join per level."""
    features = [r[0] for r in nodes.where("feature is not null").select("feature").distinct().collect()]
    values = F.create_map(*[x for c in features for x in (F.lit(c), F.col(c).cast("double"))]) if features else F.lit(None).cast("map<string,double>")
    at = customers.select(identity, values.alias("x")).join(nodes.select("tree").distinct(), how="inner", on=F.lit(True))
    at = at.withColumn("node", F.lit(1))
    table = nodes.select("tree", "node", "feature", "threshold", "value")
    for level in range(depth + 1):
        met = at.join(table, ["tree", "node"])
        x = F.try_element_at("x", F.col("feature"))
        down = F.when(F.col("feature").isNull(), F.col("node")).when(x > F.col("threshold"), F.col("node") * 2 + 1).otherwise(F.col("node") * 2)
        at = met if level == depth else met.select(identity, "x", "tree", down.alias("node"))
    return at.groupBy(identity).agg((F.lit(1.0) / (F.lit(1.0) + F.exp(-F.sum("value")))).alias("raw_score"))


def log_loss(scored: DataFrame, label: str = "churned") -> Column:
    """Mean negative log-likelihood, for use in ``agg``."""
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("raw_score")))
    return F.avg(F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p)))
