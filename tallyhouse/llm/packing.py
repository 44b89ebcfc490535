"""Token sequences of fixed capacity filled by large-item matching and best fit."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tallyhouse.config import stored
from tallyhouse.llm.common import bounded_batches, frugal, ranges_for, with_starts
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

CAPACITY = 2048
END_OF_DOCUMENT = 0
# Words that the cache of one Python worker may hold.
WORDS = 400_000
# Words of more bytes are not kept in it; long texts are encoded in stretches of this many bytes.
LONG_WORD, STRETCH = 64, 1 << 20

# The word pattern of the vocabulary, for lower-case Latin-1 text.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
BLANK = re.compile(rb"\s")
# Texts that show whether a vocabulary looks at one lower-cased word at a time.
PROBES = ["Hello World, this is A Test", "It's I'LL ''s 12a3-b4\tÉTÉ naïve\n\n  x", "a\nb a  b", "日本語 テスト。 ΣΑΣ"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Cache:
    """Ids by word in two halves: when the newer one is full, the older one is forgotten.

    Words in use move to the newer half, so the frequent ones stay.
    """

    def __init__(self) -> None:
        self.new, self.old = {}, {}

    def learn(self, ids: dict) -> None:
        if ids and max(map(len, ids)) > LONG_WORD:
            ids = {k: v for k, v in ids.items() if len(k) <= LONG_WORD}
        if len(self.new) + len(ids) > WORDS // 2:
            self.old, self.new = self.new, {}
        self.new.update(ids)

    def older(self, words: set) -> dict:
        """Those of ``words`` that the older half knows."""
        return {w: self.old[w] for w in words & self.old.keys()}


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, the same as the tokenizer's own.

    A vocabulary that drops white space and looks at one lower-cased word at a time gives a
    text the ids of its words in a row. Whether it does is tried on ``PROBES``; any other
    vocabulary encodes whole texts. Words seen before come from a cache of bounded size; what
    is not plain Latin-1 goes to the tokenizer as it is.
    """

    open: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.array(
            [self.tokenizer.id_to_token(i).endswith("</w>") for i in range(self.tokenizer.get_vocab_size())]
        )
        self.known = Cache()
        self.by_word = all(self._by_word(t) == self._whole([t])[0] for t in PROBES)

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls.open:
            cls.open[path] = cls(path)
        return cls.open[path]

    def encode(self, text: str) -> bytes:
        if not self.by_word or "<|" in text:  # may hold a special token, which is found before anything else
            return self._whole([text])[0]
        return self._by_word(text)

    def _by_word(self, text: str) -> bytes:
        data, parts, at = text.encode().lower(), [], 0
        while at < len(data):
            cut = BLANK.search(data, at + STRETCH)
            end = cut.start() if cut else len(data)
            parts.append(self._stretch(data[at:end].split()))
            at = end
        return b"".join(parts)

    def _stretch(self, chunks: list[bytes]) -> bytes:
        found = list(map(self.known.new.get, chunks))
        if None in found:
            missing = {c for c, known in zip(chunks, found, strict=True) if known is None}
            new = self.known.older(missing)
            new.update(self._ids_of(missing - new.keys()))
            found = [new[c] if known is None else known for c, known in zip(chunks, found, strict=True)]
            self.known.learn(new)
        return b"".join(found)

    def _ids_of(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        plain, other = [], []
        for c in chunks:
            text = c.decode()
            if PLAIN.fullmatch(text):
                plain.append((c, [w.encode() for w in PIECES.findall(text.lower())]))
            else:
                other.append(c)
        words = {w: self.known.new.get(w) for _, parts in plain for w in parts}
        missing = {w for w, ids in words.items() if ids is None}
        learned = self.known.older(missing)
        new = list(missing - learned.keys())
        for i in range(0, len(new), 256):
            learned.update(zip(new[i : i + 256], self._of_words(new[i : i + 256]), strict=True))
        self.known.learn(learned)
        words.update(learned)
        ids = {c: b"".join([words[w] for w in parts]) for c, parts in plain}
        if other:
            ids.update(zip(other, self._whole([c.decode() for c in other]), strict=True))
        return ids

    def _of_words(self, words: list[bytes]) -> list[bytes]:
        ids = np.array(self._ids([b" ".join(words).decode()])[0], "<u4")
        last = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(last) == len(words):
            data = ids.tobytes()
            return [data[a:b] for a, b in zip([0, *last[:-1]], last, strict=True)]
        return self._whole([w.decode() for w in words])

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self._ids(texts)]


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A document is the ids of its text (null: empty) and one end id, so an empty one has
    length 1. Only documents longer than ``capacity`` are cut, into full pieces and a rest.
    Other columns are left out; a null id or a repeated row is a document like any other.
    """
    path = tokenizer or default_tokenizer()
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    long = [StructField(c, LongType()) for c in ("piece", "start", "length", "ids_crc32")]
    ids = StructField("ids", ArrayType(IntegerType()) if with_ids else BinaryType())
    schema = StructType([StructField("_id", id_type), *long, ids])
    end = np.array([END_OF_DOCUMENT], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(path)
        for batch in batches:
            rows, which = [], []
            for i, text in enumerate(batch.column(1)):
                data = encoder.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    which.append(i)
                    rows.append((piece, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<u4") if with_ids else None))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()) if with_ids else pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which, pa.int64())), *arrays], ["_id", "piece", "start", "length", "ids_crc32", "ids"]
            )

    pieces = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text")).mapInArrow(frugal(cut), schema)
    return pieces.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(number of bins, their items as (length, copies)) for so many pieces of each length.

    Lengths above a third of the capacity come first: at most two fit into a bin, so the
    longest is matched with the longest partner that fits, and stays alone if none does.
    Shorter ones follow by falling length, each into the smallest gap that holds it. All
    pieces of one length move together, so the work depends on the number of lengths, at
    most ``capacity``, not on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []

    def put(gap: int, number: int, items: list[tuple[int, int]]) -> None:
        if number:
            if gap not in bins:
                bins[gap] = []
                insort(gaps, gap)
            bins[gap].append((number, items))

    while large:
        a = large[-1]
        i = bisect_left(large, capacity - a + 1) - 1
        if i == len(large) - 1 and left[a] == 1:
            i -= 1
        if i < 0:
            put(capacity - a, left.pop(a), [(a, 1)])
            large.pop()
            continue
        b = large[i]
        number = left[a] // 2 if a == b else min(left[a], left[b])
        put(capacity - a - b, number, [(a, 2)] if a == b else [(a, 1), (b, 1)])
        for n in (a, b):
            left[n] -= number
            if not left[n]:
                del left[n]
                large.remove(n)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        while todo:
            i = bisect_left(gaps, n)
            if i == len(gaps):
                gap, number, items = capacity, -(-todo // (capacity // n)), []
            else:
                gap = gaps[i]
                number, items = bins[gap].pop()
                if not bins[gap]:
                    del bins[gap], gaps[i]
            each = gap // n
            full = min(number, todo // each)
            rest = todo - full * each if full < number else 0
            put(gap - each * n, full, [*items, (n, each)])
            if rest:
                put(gap - rest * n, 1, [*items, (n, rest)])
            put(gap, number - full - bool(rest), items)
            todo -= full * each + rest
    return [group for gap in gaps for group in bins[gap]]


def pack(pieces: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, parts: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``.

    Only the count of each length reaches the driver. Pieces are numbered by (length, id,
    piece) over ranges, so a length that a third of all pieces share is no single task, and
    each number maps to a place through a table whose size depends on the capacity alone.
    Sequences have no gaps and are numbered from 0. Pieces that agree in all three may swap
    places. An empty table gives an empty table.
    """
    fixed = stored(pieces, "pieces")
    counts = {r.length: r["count"] for r in fixed.groupBy("length").count().collect()}
    plan = plan_bins(counts, capacity)
    runs: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in counts}
    base = 0
    for number, items in plan:
        offset = 0
        for n, copies in items:
            runs[n].append((number * copies, base, copies, offset))
            offset += n * copies
        base += number
    segments, at = [], 0
    for n in sorted(runs):
        for items, first, copies, offset in runs[n]:
            segments.append((at, n, first, copies, offset))
            at += items
    steps = np.array(segments, np.int64).reshape(-1, 5)
    ranked = with_starts(
        fixed, [F.col("length"), F.col(id_col), F.col("piece")], {"_rank": F.lit(1)}, parts or ranges_for(fixed)
    )
    kept = [f for f in ranked.schema.fields if f.name != "_rank"]
    schema = StructType([*kept, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index("_rank")
            rank = batch.column(i).to_numpy(zero_copy_only=False)
            kept = [c for j, c in enumerate(batch.columns) if j != i]
            s = steps[np.searchsorted(steps[:, 0], rank, "right") - 1] if len(rank) else steps[:0]
            k = rank - s[:, 0]
            new = [pa.array(s[:, 2] + k // s[:, 3]), pa.array(s[:, 4] + k % s[:, 3] * s[:, 1])]
            yield pa.RecordBatch.from_arrays([*kept, *new], schema.names)

    return ranked.mapInArrow(place, schema)


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return pack(token_pieces(docs)).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset"
    )
