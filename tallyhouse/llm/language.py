"""Language identification by a convolutional network over bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyhouse.llm.common import bounded_batches, drawn, frugal
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
DIMENSIONS = 6
# Bounds of the labelled sample the network is fitted on.
SAMPLE_ROWS = 4000
SAMPLE_WINDOWS = 3
EPOCHS = 6
REJECT_BELOW = 0.4


@dataclass
class ByteNet:
    """Byte embedding, filters of several widths, maximum over the window, softmax.

    Filters are kept in one matrix over the widest window; a narrower filter has zeros in
    the rows of its last bytes. Byte 0 is padding and embeds to zero.
    """

    labels: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    shift: np.ndarray

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """Every filter at every position: (windows, positions, filters)."""
        number, length = windows.shape
        widest = max(WIDTHS)
        x = np.zeros((number, length + widest - 1, DIMENSIONS), np.float32)
        x[:, :length] = self.embedding[windows]
        flat = x.reshape(number, -1)
        step = flat.strides[1]
        seen = np.lib.stride_tricks.as_strided(
            flat, (number, length, widest * DIMENSIONS), (flat.strides[0], DIMENSIONS * step, step)
        )
        return (seen.reshape(number * length, -1) @ self.filters).reshape(number, length, -1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.responses(windows).max(1) + self.bias, 0)
        return softmax(pooled @ self.dense + self.shift)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """All bytes of a text in rows of fixed length, the last one padded with zeros."""
    rows = -(-len(data) // WINDOW)
    return np.frombuffer(data.ljust(rows * WINDOW, b"\0"), np.uint8).reshape(rows, WINDOW)


def fit_network(labels: Sequence[str], texts: Sequence[bytes], epochs: int = EPOCHS, seed: int = 7) -> ByteNet:
    """Train on labelled windows; the same rows in the same order give the same network.

    Every pass sees each window cut to a random length, so that short texts are learned
    too. Classes weigh the same. The gradient of the maximum flows to one position per
    filter only, so a step costs little more than a prediction.
    """
    names = sorted(set(labels))
    target = np.array([names.index(x) for x in labels])
    draw = np.random.default_rng(seed)
    widest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    live = np.repeat(np.concatenate([np.tile((np.arange(widest) < w)[:, None], (1, FILTERS)) for w in WIDTHS], 1), DIMENSIONS, 0)
    net = ByteNet(
        names,
        draw.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32),
        (draw.normal(0, 0.3, (widest * DIMENSIONS, total)) * live).astype(np.float32),
        np.zeros(total, np.float32),
        draw.normal(0, 0.2, (total, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    net.embedding[0] = 0
    weight = (len(target) / (len(names) * np.bincount(target, minlength=len(names))))[target].astype(np.float32)
    data = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        part = np.frombuffer(t[:WINDOW], np.uint8)
        data[i, : len(part)] = part
    sizes = np.array([min(len(t), WINDOW) for t in texts])
    params = [net.embedding, net.filters, net.bias, net.dense, net.shift]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            keep = np.maximum(np.minimum(sizes[rows], 8), (sizes[rows] * np.minimum(1, draw.uniform(0.05, 1.3, len(rows)))).astype(int))
            batch = np.where(np.arange(WINDOW) < keep[:, None], data[rows], 0)
            out = net.responses(batch)
            top = out.argmax(1)
            before = np.take_along_axis(out, top[:, None], 1)[:, 0] + net.bias
            pooled = np.maximum(before, 0)
            wrong = softmax(pooled @ net.dense + net.shift)
            wrong[np.arange(len(rows)), target[rows]] -= 1
            wrong *= weight[rows, None] / len(rows)
            back = (wrong @ net.dense.T) * (before > 0)
            padded = np.pad(batch, ((0, 0), (0, widest - 1)))
            bytes_seen = padded[np.arange(len(rows))[:, None, None], top[:, :, None] + np.arange(widest)]
            seen = net.embedding[bytes_seen].reshape(len(rows), total, -1)
            to_bytes = back[:, :, None, None] * net.filters.T.reshape(1, total, widest, DIMENSIONS)
            embedding = np.zeros_like(net.embedding)
            np.add.at(embedding, bytes_seen.ravel(), to_bytes.reshape(-1, DIMENSIONS))
            embedding[0] = 0
            gradients = [
                embedding, np.einsum("bf,bfd->df", back, seen) * live, back.sum(0), pooled.T @ wrong, wrong.sum(0),
            ]
            step += 1
            rate = 0.01 * (1 - epoch / (epochs + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, a, b in zip(params, gradients, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
    return net


def training_windows(
    docs: DataFrame, text_col: str, label_col: str, id_col: str, rows: int = SAMPLE_ROWS, each: int = SAMPLE_WINDOWS
) -> list[tuple[str, bytes]]:
    """At most ``rows`` labelled documents, drawn by a hash of the id, and ``each`` windows spread over each.

    The bound holds whatever the size of the table; null labels and texts without a letter
    are left out.
    """
    text, size = F.col("_text"), F.char_length("_text")
    windows = F.transform(
        F.sequence(F.lit(0), F.lit(each - 1)),
        lambda i: F.substring(text, (i * (size / each)).cast("int") + 1, F.lit(WINDOW)),
    )
    named = docs.select(
        docs[text_col].alias("_text"), docs[label_col].cast("string").alias("_label"), docs[id_col].cast("string").alias("_id")
    ).where("_label is not null")
    sample = (
        named.where(drawn(F.coalesce("_id", F.lit("")), rows, named.count()) & F.col("_text").rlike(r"\p{L}"))
        .select("_label", F.xxhash64(F.lit("language"), "_id").alias("_draw"), F.array_distinct(windows).alias("_windows"))
        .orderBy("_draw", "_label", "_windows")
        .limit(rows)
        .collect()
    )
    found = [(r._label, w.encode()[:WINDOW]) for r in sample for w in r._windows if w]
    return sorted(found)


def identify(docs: DataFrame, net: ByteNet | None, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` from the whole of each text.

    A text is cut into windows of 256 bytes; the score of a language is the mean of its
    probabilities over the windows, weighed by their bytes. A null text, one without a
    letter, or any text when no network could be trained is ``und`` with score 0. Other
    columns stay as they are; columns of those two names are replaced. Memory does not
    depend on the length of a text beyond the text itself.
    """
    bounded_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = names.index(text_col)
    kept = docs.select(*names)
    schema = StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for i, p in predictions(net, texts):
                lang[i], score[i] = net.labels[int(p.argmax())], float(p.max())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], schema.names
            )

    return kept.mapInArrow(frugal(predict), schema)


def predictions(net: ByteNet | None, texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, probabilities) of the texts that have a letter; windows of many texts go through together."""
    if net is None:
        return
    rows, parts, used = [], [], 0
    sums = {}
    for i, text in enumerate(texts):
        if text and any(map(str.isalpha, text)):
            sums[i] = [np.zeros(len(net.labels)), 0]
            data = text.encode()
            windows = windows_of(data)
            for k in range(0, len(windows), 128):
                part = windows[k : k + 128]
                rows.append((i, len(part), len(data) - (len(windows) - 1) * WINDOW if k + 128 >= len(windows) else WINDOW))
                parts.append(part)
                used += len(part)
                if used >= 128:
                    _add(net, rows, parts, sums)
                    rows, parts, used = [], [], 0
    if rows:
        _add(net, rows, parts, sums)
    for i, (total, size) in sums.items():
        yield i, total / size


def _add(net: ByteNet, rows: list, parts: list, sums: dict) -> None:
    p, at = net.probabilities(np.concatenate(parts)), 0
    for i, number, last in rows:
        weights = np.full(number, WINDOW)
        weights[-1] = last
        sums[i][0] += weights @ p[at : at + number]
        sums[i][1] += weights.sum()
        at += number


def train_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> ByteNet | None:
    """A network for the languages of the labelled sample; None where it has no rows."""
    sample = training_windows(docs, text_col, label_col, id_col)
    return fit_network([s[0] for s in sample], [s[1] for s in sample]) if sample else None


def hash_remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", least: float = REJECT_BELOW
) -> DataFrame:
    """Drop documents that no language is found for: ``und``, or a score below ``least``.

    The network learns from those rows with a label whose remainder modulo 5 is not 0.
    """
    net = train_language(docs.where(hash_remainder(F.col(id_col), 5) != 0), id_col, text_col, label_col)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), docs[text_col].alias("_text"))
    found = identify(rows, net, "_text")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("_row.*")


@query("op6_language_id")
def op6_language_id(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    held_out = hash_remainder(F.col("doc_id"), 5) == 0
    net = train_language(docs.where(~held_out))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return identify(rows, net).select("doc_id", "held_out", "lang_pred", "score")
