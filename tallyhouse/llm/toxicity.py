"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from tallyhouse.llm.common import bounded_batches, drawn
from tallyhouse.llm.language import hash_remainder
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

ORDERS = (3, 4, 5, 6)
BITS = 18
# Bound of the labelled sample the classifier is fitted on: rows of each class.
SAMPLE_PER_CLASS = 1000
ROUNDS = 40
RIDGE = 2e-2
THRESHOLD = 0.7

# Multipliers of the rolling hash.
RADIX, SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@dataclass
class NgramModel:
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        """Probability of the positive class; an empty text gets the intercept's alone."""
        total = self.intercept + float(self.weights[features(text or "")].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def features(text: str) -> np.ndarray:
    """Buckets of the distinct character n-grams of a whole text, in ascending order.

    Lower-cased, with a blank before and after. Long texts go through in pieces that
    overlap by the longest n-gram, so memory stays bounded.
    """
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    seen = np.zeros(1 << BITS, bool)
    longest = max(ORDERS)
    for at in range(0, max(1, len(codes) - longest + 1), 1 << 16):
        part = codes[at : at + (1 << 16) + longest - 1]
        rolled = part
        for n in range(2, longest + 1):
            if len(part) < n:
                break
            rolled = rolled[: len(part) - n + 1] * RADIX + part[n - 1 :]
            if n in ORDERS:
                seen[((rolled + np.uint32(n)) * SPREAD) >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen)


def fit_ngrams(labels: Sequence[int], rows: Sequence[np.ndarray], prior: float = 0.5) -> NgramModel:
    """Logistic regression with a ridge over n-gram presence times its log-count ratio.

    The ratio of an n-gram is the logarithm of its share among positive rows over its share
    among negative ones (one added to each count). ``prior`` is the share of positive rows
    in the whole of the labelled rows, of which the sample may hold another share; the
    intercept is moved by the difference. Without rows of both classes the score is the
    prior everywhere.
    """
    y = np.asarray(labels, np.float64)
    size = 1 << BITS
    positives = float(y.sum())
    edge = min(max(prior, 1e-4), 1 - 1e-4)
    if not 0 < positives < len(y):
        return NgramModel(np.zeros(size), float(np.log(edge / (1 - edge))))
    p, q = np.ones(size), np.ones(size)
    for label, row in zip(y, rows, strict=True):
        (p if label else q)[row] += 1
    ratio = np.log(p / p.sum() * q.sum() / q)
    ratio[p + q < 5] = 0  # seen fewer than three times
    w, b = np.zeros(size), 0.0
    m, v, bm, bv = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        scaled, g, gb = w * ratio, np.zeros(size), 0.0
        for label, row in zip(y, rows, strict=True):
            wrong = (1 / (1 + np.exp(-np.clip(scaled[row].sum() + b, -50, 50))) - label) / len(y)
            g[row] += wrong  # the n-grams of a row are distinct
            gb += wrong
        g = g * ratio + RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        bm, bv = 0.9 * bm + 0.1 * gb, 0.99 * bv + 0.01 * gb * gb
        rate = 0.05 * (1 - (step - 1) / ROUNDS)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * (ratio != 0)
        b -= rate * (bm / (1 - 0.9**step)) / (np.sqrt(bv / (1 - 0.99**step)) + 1e-8)
    share = positives / len(y)
    moved = b + np.log(edge / (1 - edge)) - np.log(share / (1 - share))
    return NgramModel(w * ratio, float(moved))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> NgramModel:
    """Fit on at most ``SAMPLE_PER_CLASS`` labelled documents of each class, drawn by a hash of the id.

    Rows without a 0/1 label or without a document are left out; a document that is
    labelled twice counts twice. The share of positive labels covers all rows of ``labels``.
    """
    marked = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_y")).where("_y in (0, 1)")
    shares = {r._y: r["count"] for r in marked.groupBy("_y").count().collect()}
    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    draw = F.xxhash64(F.lit("toxicity"), key)
    chosen = [
        marked.where((F.col("_y") == y) & drawn(key, SAMPLE_PER_CLASS, shares.get(y, 0))).orderBy(draw, "_id").limit(SAMPLE_PER_CLASS)
        for y in (0, 1)
    ]
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    sample = rows.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_id")  # bounded by the two limits
    bounded_batches(docs.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t or "").astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["y", "found"])

    schema = StructType([StructField("y", IntegerType()), StructField("found", BinaryType())])
    got = sample.select("_y", "_text").mapInArrow(extract, schema).toArrow()
    pairs = sorted(zip(got["y"].to_pylist(), got["found"].to_pylist(), strict=True))
    prior = shares.get(1, 0) / max(1, sum(shares.values()))
    return fit_ngrams([y for y, _ in pairs], [np.frombuffer(f, "<u4") for _, f in pairs], prior)


def score_toxicity(docs: DataFrame, model: NgramModel, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on) from the whole of each text; null counts as empty.

    Other columns stay as they are; columns of those two names are replaced.
    """
    bounded_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    at = names.index(text_col)
    kept = docs.select(*names)
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(t) for t in batch.column(at).to_pylist()], np.float64)
            predicted = pa.array((scores >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), predicted], schema.names)

    return kept.mapInArrow(predict, schema)


@query("op7_toxicity")
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    model = train_toxicity(docs, labels.where(hash_remainder(F.col("doc_id"), 3) != 1))
    rows = docs.select("doc_id", "text", (hash_remainder(F.col("doc_id"), 3) == 1).alias("held_out"))
    return score_toxicity(rows, model).select("doc_id", "held_out", "score", "predicted")
