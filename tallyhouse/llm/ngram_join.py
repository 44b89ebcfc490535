"""Jaccard join of documents over word n-grams as a blocked sparse matrix product."""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.config import paths_of, release, stored, watched_tables
from tallyhouse.llm.common import bounded_batches, frugal
from tallyhouse.llm.components import connected_components
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

# Documents per side and n-grams per step of one block of the product.
TILE = 256
COLUMNS = 8192
# Sets that one task remembers, and block keys that it sorts at a time.
KNOWN = 1_000_000
FLUSH = 2_000_000
# Holders of one key in such a stretch from which it counts as crowded, and documents per bucket of keys.
HOT = 256
BUCKET_ROWS = 1024
# N-grams of members per bucket, when those that no other member holds are counted.
BUCKET_GRAMS = 1 << 20

# Odd multipliers that mix 64-bit hashes.
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * M1
    h = (h ^ (h >> np.uint64(29))) * M2
    return h ^ (h >> np.uint64(32))


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * M3)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
STRETCH = 1 << 20


def _powers(base: int) -> np.ndarray:
    out = np.full(1, 1, np.uint64)
    while len(out) < STRETCH:
        out = np.concatenate([out, out * np.uint64(base)])
        base = base * base % (1 << 64)
    return out


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and those of its inverse."""
    base = int(M2)
    return _powers(base), _powers(pow(base, -1, 1 << 64))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit polynomial hash of each word between ASCII white space, from running sums over stretches of the bytes.

    A word that a stretch leaves open goes on in the next one with its sum and length so far.
    """
    up, down = powers()
    out, carried, length = [], np.zeros(0, np.uint64), 0
    for at in range(0, len(data), STRETCH):
        codes = np.frombuffer(data, np.uint8, min(STRETCH, len(data) - at), at)
        blank = np.ones(len(codes) + 2, bool)
        blank[1:-1] = SPACE[codes]
        change = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = change[::2], change[1::2]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(BYTE_CODES[codes] * up[: len(codes)], out=sums[1:])
        h, sizes = (sums[ends] - sums[starts]) * down[starts], ends - starts
        if length and len(starts) and starts[0] == 0:
            h[:1] = carried + h[:1] * np.uint64(pow(int(M2), length, 1 << 64))
            sizes[0] += length
        elif length:
            out.append(carried)
        length = 0
        if len(ends) and ends[-1] == len(codes):
            carried, length, h = h[-1:], int(sizes[-1]), h[:-1]
        out.append(h)
    if length:
        out.append(carried)
    return mixed(np.concatenate(out)) if out else carried


class Ngrams:
    """64-bit hashes of the distinct word n-grams of texts, in ascending order."""

    def __init__(self, words: int) -> None:
        self.words = words

    def of(self, text: str | None) -> np.ndarray:
        h = word_hashes((text or "").encode().lower())  # lowers A-Z only
        if not len(h):
            return h
        size = min(self.words, len(h))
        rolled = np.full(len(h) - size + 1, np.uint64(size))
        for k in range(size):
            rolled = mixed(rolled * M3 + h[k : len(h) - size + 1 + k])
        return np.unique(rolled)


class Blocks:
    """Keys of n-gram blocks that two sets of a pair above the threshold cannot all differ in.

    Sizes are dealt into bands that grow by the inverse of the threshold, so two linked sets
    lie in one band or in neighbouring ones. For a smaller set of band j and its partner the
    sizes bound the n-grams in which they differ by d. The hash range is cut into d + 1 + s
    blocks; at least s + 1 of them are equal in both sets. The key of a block stands for its
    n-grams. Empty blocks have no key, unless a set has more than s of them: only then
    might all the equal blocks be empty. s is about what chance leaves empty.
    """

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.edges = [1]

    def band(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(self.edges[-1] * 100 // self.percent + 1)
        return bisect_right(self.edges, size) - 1

    @lru_cache(maxsize=4096)  # noqa: B019
    def shape(self, band: int) -> tuple[int, int]:
        """Number of blocks and s."""
        while len(self.edges) < band + 3:
            self.edges.append(self.edges[-1] * 100 // self.percent + 1)
        small = self.edges[band + 1] - 1
        large = min(self.edges[band + 2] - 1, small * 100 // self.percent)
        differ = (small + large) * (100 - self.percent) // (100 + self.percent)
        chance = (differ + 1) * math.exp(-self.edges[band] / (differ + 1)) if differ else 0.0
        spare = math.ceil(chance + 4 * math.sqrt(chance)) if chance > 1e-3 else 0
        return differ + 1 + spare, spare

    def keys(self, grams: np.ndarray) -> np.ndarray:
        band, out = self.band(len(grams)), []
        sums = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(mixed(grams), out=sums[1:])
        high = grams >> np.uint64(32)
        for j in (band - 1, band) if band else (band,):
            number, spare = self.shape(j)
            places = np.arange(number + 1, dtype=np.uint64)
            cuts = np.searchsorted(high, -((-(places << np.uint64(32)).astype(np.int64)) // number).astype(np.uint64))
            full = cuts[1:] > cuts[:-1]
            if number - full.sum() > spare:
                full[:] = True
            content = sums[cuts[1:]] - sums[cuts[:-1]]
            out.append(mixed(mixed(content + places[:-1] * M3) + np.uint64(j + 1))[full])
        return np.concatenate(out)


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def handle(key: bytes) -> int:
    """A short name of a set for the search of candidates; two sets that share one are compared."""
    return int.from_bytes(key[:8], "little", signed=True)


def _search(words: int, percent: int, bits: int, hot: int):
    """Block keys with the sets that hold them, packed by bucket (a range of keys), and what each text is.

    A row of keys has the ``bucket``, the next 40 bits of each key in ascending order and the
    handle of its set. A key that more than ``hot`` sets of one stretch of rows hold goes out once for the
    stretch, and the pairs of its first set with the others on their own (``b`` is the first): so a key that
    very many documents hold is few rows.
    """
    names = ["bucket", "keys", "owners", "b", "text"]
    fields = ["id", "n", "key"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, blocks, done = Ngrams(words), Blocks(percent), set()
        keys, owners, held = [], [], 0
        text_type = None

        def packed() -> Iterator[pa.RecordBatch]:
            key, owner = np.concatenate(keys), np.repeat(np.array([o for o, _ in owners], np.int64), [n for _, n in owners])
            order = np.lexsort((owner, key))
            key, owner = key[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.diff(np.append(first, len(key)))
            crowded = np.repeat(count > hot, count)
            crowded[first] = False
            leader = np.repeat(owner[first], count)
            pairs = np.unique(np.stack([leader[crowded], owner[crowded]], 1), axis=0)
            key, owner = key[~crowded], owner[~crowded]
            bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
            low = np.ascontiguousarray((key << np.uint64(bits)) >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(cuts[1:], len(key))
            for at in range(0, len(cuts), 64):
                spans = list(zip(cuts[at : at + 64], ends[at : at + 64], strict=True))
                n = len(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket[x] for x, _ in spans], pa.int64()), pa.array([low[x:y].tobytes() for x, y in spans], pa.binary()),
                        pa.array([owner[x:y].tobytes() for x, y in spans], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, text_type),
                    ], names,
                )
            firsts = np.unique(pairs[:, 0], return_index=True)[1]
            for x, y in zip(firsts, [*firsts[1:], len(pairs)], strict=False):
                where = int(mixed(pairs[x : x + 1, 0].astype(np.uint64))[0] >> np.uint64(64 - bits))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([where]), pa.nulls(1, pa.binary()), pa.array([pairs[x:y, 1].tobytes()], pa.binary()),
                        pa.array([int(pairs[x, 0])]), pa.nulls(1, text_type),
                    ], names,
                )

        for batch in batches:
            id_type = batch.column(1).type
            text_type = pa.struct(list(zip(fields, (id_type, pa.int64(), pa.binary()), strict=True)))
            texts = [grams.of(t) for t in batch.column(0).to_pylist()]
            set_keys = [set_key(g) if len(g) else None for g in texts]
            n = len(texts)
            spread = np.array([handle(k) if k else i for i, k in enumerate(set_keys)], np.int64)
            spread = (mixed(spread.view(np.uint64) + np.arange(n, dtype=np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
            described = [batch.column(1), pa.array([len(g) for g in texts], pa.int64()), pa.array(set_keys, pa.binary())]
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(spread), none, none, pa.nulls(n, pa.int64()), pa.StructArray.from_arrays(described, fields)], names
            )
            for g, k in zip(texts, set_keys, strict=True):
                if k is None or handle(k) in done:
                    continue
                if len(done) < KNOWN:
                    done.add(handle(k))
                found = blocks.keys(g)
                keys.append(found)
                owners.append((handle(k), len(found)))
                held += len(found)
                if held >= FLUSH:
                    yield from packed()
                    keys, owners, held = [], [], 0
        if held:
            yield from packed()

    return search


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: for each key the pairs of its smallest set (``a``) with the others (``b``), once per bucket.

    Pairs that were split off (``hot``) and descriptions of texts pass through.
    """
    current, keys, owners = None, [], []
    text_type = None

    def rows(a: np.ndarray, b: np.ndarray, hot: bool) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(n, hot)), pa.nulls(n, text_type)], ["a", "b", "hot", "text"])

    def pairs() -> pa.RecordBatch:
        low = np.zeros((sum(len(k) for k in keys) // 5, 8), np.uint8)
        low[:, :5] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 5)
        key, owner = low.view(np.uint64).ravel(), np.frombuffer(b"".join(owners), np.int64)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        leader = np.repeat(owner[first], np.diff(np.append(first, len(key))))
        found = np.unique(np.stack([leader, owner], 1)[leader != owner], axis=0)
        return rows(found[:, 0].copy(), found[:, 1].copy(), False)

    for batch in batches:
        text_type = batch.column(4).type
        texts = batch.column(4)
        if texts.null_count < len(texts):
            whole = texts.drop_null()
            n = len(whole)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), whole], ["a", "b", "hot", "text"])
        for bucket, k, o, b in zip(*[c.to_pylist() for c in batch.columns[:4]], strict=True):
            if bucket != current:
                if keys:
                    yield pairs()
                current, keys, owners = bucket, [], []
            if k is not None:
                keys.append(k)
                owners.append(o)
            elif b is not None:
                others = np.frombuffer(o, np.int64)
                yield rows(np.full(len(others), b, np.int64), others, True)
    if keys:
        yield pairs()


def _sets(words: int):
    """The n-grams of texts whose set is the wanted one, with the groups that it is in."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Ngrams(words)
        for batch in batches:
            found = [grams.of(t) for t in batch.column(0).to_pylist()]
            wanted = batch.column(1).to_pylist()
            same = [i for i, g in enumerate(found) if len(g) and set_key(g) == wanted[i]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([wanted[i] for i in same], pa.binary()), batch.column(2).take(pa.array(same, pa.int64())),
                    pa.array([found[i].tobytes() for i in same], pa.binary()),
                ], ["key", "groups", "grams"],
            )

    return sets


def _scattered(bits: int):
    """N-grams of members (``id``, ``g``, ``grams``), each told apart by its group, packed by bucket (some groups, or parts of groups).

    All n-grams of a group meet in one bucket; those of a large one are dealt by their hashes into ``parts`` (1 where that
    column is left out). A row has the first 40 bits of each hash and, for the first of them, which member of a stretch of rows is the
    only one there that holds it: ids with the number of hashes in a row that are theirs. One that several members of the
    stretch hold goes out once, without an id: so an n-gram that very many members hold is few entries.
    """
    names = ["bucket", "keys", "owners"]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, buckets, owners, held = [], [], [], 0

        def packed() -> pa.RecordBatch:
            key, bucket = np.concatenate(keys), np.concatenate(buckets)
            owner = np.repeat(np.array([o for o, _ in owners], np.int64), [n for _, n in owners])
            order = np.argsort(key)
            key, bucket, owner = key[order], bucket[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            several = np.diff(np.append(first, len(key))) > 1
            key, bucket, owner = key[first], bucket[first], owner[first]
            order = np.lexsort((owner, several, bucket))
            key, bucket, owner, several = key[order], bucket[order], owner[order], several[order]
            low = np.ascontiguousarray(key >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            spans = list(zip(cuts, np.append(cuts[1:], len(key)), strict=True))

            def runs(x: int, y: int) -> bytes:
                own = owner[x:y][~several[x:y]]
                starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
                return np.stack([own[starts], np.diff(np.append(starts, len(own)))], 1).tobytes()

            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[cuts]), pa.array([low[x:y].tobytes() for x, y in spans], pa.binary()),
                    pa.array([runs(x, y) for x, y in spans], pa.binary()),
                ], names,
            )

        for batch in batches:
            parts = batch.column(3) if batch.num_columns > 3 else pa.array([1] * len(batch))
            for i, g, grams, cut in zip(*[c.to_pylist() for c in [*batch.columns[:3], parts]], strict=True):
                group = mixed(np.array([g], np.int64).view(np.uint64))
                found = mixed(np.frombuffer(grams, np.uint64) ^ group)
                keys.append(found)
                buckets.append((mixed(group + (found % np.uint64(cut)) * M3) >> np.uint64(64 - bits)).astype(np.int64))
                owners.append((i, len(found)))
                held += len(found)
                if held >= FLUSH:
                    yield packed()
                    keys, buckets, owners, held = [], [], [], 0
        if held:
            yield packed()

    return scatter


def _unshared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: per member (``id``) how many of its n-grams there no other member of the group holds."""
    current, keys, owners = None, [], []

    def counted() -> pa.RecordBatch:
        low = np.zeros((sum(len(k) for k in keys) // 5, 8), np.uint8)
        low[:, :5] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 5)
        key = low.view(np.uint64).ravel()
        runs = [np.frombuffer(o, np.int64).reshape(-1, 2) for o in owners]
        owned = np.concatenate([np.arange(len(k) // 5) < r[:, 1].sum() for k, r in zip(keys, runs, strict=True)])
        owner = np.zeros(len(key), np.int64)
        runs = np.concatenate(runs)
        owner[owned] = np.repeat(runs[:, 0], runs[:, 1])
        order = np.argsort(key)
        key, owner, owned = key[order], owner[order], owned[order]
        new = np.concatenate([[True], key[1:] != key[:-1], [True]])
        ids, n = np.unique(owner[new[1:] & new[:-1] & owned], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["id", "unshared"])

    for batch in batches:
        for bucket, k, o in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if bucket != current:
                if keys:
                    yield counted()
                current, keys, owners = bucket, [], []
            keys.append(k)
            owners.append(o)
    if keys:
        yield counted()


def overlap_links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of rows reach the threshold: (rows of left, rows of right) booleans.

    Multiplies the two incidence matrices in blocks of n-grams that both sides hold, adds up
    the overlaps, and stops when no pair can still reach the bound its sizes set.
    """
    a, b = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    need = np.ceil((a[:, None] + b) * percent / (100 + percent) - 1e-9)
    need[np.minimum.outer(a, b) * 100 < np.maximum.outer(a, b) * percent] = np.inf
    rows_a, rows_b = np.repeat(np.arange(len(left)), a), np.repeat(np.arange(len(right)), b)
    values_a, values_b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(values_a, values_b)
    keep_a, keep_b = np.isin(values_a, shared), np.isin(values_b, shared)
    rows_a, rows_b = rows_a[keep_a], rows_b[keep_b]
    at_a, at_b = np.searchsorted(shared, values_a[keep_a]), np.searchsorted(shared, values_b[keep_b])
    rest_a, rest_b = np.bincount(rows_a, minlength=len(left)), np.bincount(rows_b, minlength=len(right))
    overlap = np.zeros((len(left), len(right)))
    for start in range(0, len(shared), COLUMNS):
        if not (overlap + np.minimum.outer(rest_a, rest_b) >= need).any():
            return np.zeros_like(overlap, bool)
        in_a, in_b = (at_a >= start) & (at_a < start + COLUMNS), (at_b >= start) & (at_b < start + COLUMNS)
        width = min(COLUMNS, len(shared) - start)
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        x[rows_a[in_a], at_a[in_a] - start] = 1
        y[rows_b[in_b], at_b[in_b] - start] = 1
        overlap += x @ y.T
        rest_a = rest_a - np.bincount(rows_a[in_a], minlength=len(left))
        rest_b = rest_b - np.bincount(rows_b[in_b], minlength=len(right))
    return (100 * overlap >= percent * (a[:, None] + b - overlap)) & np.isfinite(need)


def spanning_links(links: np.ndarray, a: list[bytes], b: list[bytes]) -> list[tuple[bytes, bytes]]:
    """As few of the links as connect the same rows."""
    names = sorted({*a, *b})
    place = {n: i for i, n in enumerate(names)}
    near = np.zeros((len(names), len(names)), bool)
    near[np.ix_([place[n] for n in a], [place[n] for n in b])] = links
    near |= near.T
    open_, out = np.ones(len(names), bool), []
    for i in range(len(names)):
        if not open_[i]:
            continue
        open_[i] = False
        todo = [i]
        while todo:
            j = todo.pop()
            new = np.flatnonzero(near[j] & open_)
            open_[new] = False
            out += [(names[j], names[k]) for k in new]
            todo += list(new)
    return out


def _multiply(percent: int):
    """Rows sorted by block of the product; one block is at most two tiles."""

    def finish(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        left, right = {}, {}
        for _, side, key, grams in rows:
            if side != 1:
                left[key] = np.frombuffer(grams, np.uint64)
            if side != 0:
                right[key] = np.frombuffer(grams, np.uint64)
        if not left or not right:
            return []
        links = overlap_links(list(left.values()), list(right.values()), percent)
        return spanning_links(links, list(left), list(right))

    def batch_of(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        ends = [pa.array([link[i] for link in links], pa.binary()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            found = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[0] != current:
                    found += finish(rows)
                    current, rows = row[0], []
                rows.append(row)
            yield batch_of(found)
        yield batch_of(finish(rows))

    return multiply


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 90
) -> DataFrame:
    """Per document its id, ``n_shingles`` and ``component_id``.

    A set is the distinct ``words``-word n-grams of a text, A-Z lowered, words cut at ASCII
    white space; a text with fewer words is one n-gram; null and blank texts have none and
    link with nothing. Two documents link when 100 |A n B| >= ``percent`` |A u B|.
    ``component_id`` is the smallest id reachable, null only if all ids of the component are.
    N-grams are compared by 64-bit hashes, whole sets by 128-bit ones. Rows that agree in id
    count as one document where their texts agree. Other columns are left out. An empty table
    gives an empty table.

    Texts with equal sets are one class before anything is compared. Candidates are
    classes that share the key of a block (see ``Blocks``): complete, because sizes bound in how
    many blocks linked sets can differ, and selective, because a key stands for several
    n-grams. The classes that share a key form a group with the smallest of them. A class leaves a
    group that shares too few of its n-grams for any link, such as one that only a passage or line brought
    together. The incidence matrices of the others are multiplied in tiles of about ``TILE`` classes, in two
    steps: each class first meets a tile of one of its groups, which joins copies at a row or two per class; then
    groups that still hold several components multiply only what is outside their largest one (see ``_links``).
    Intermediate tables are removed as soon as nothing reads them.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(docs[text_col].alias("_text"), docs[id_col].alias("_id"))
    id_type = rows.schema["_id"].dataType.simpleString()
    bits = max(4, math.ceil(math.log2(max(1, docs.count() / BUCKET_ROWS))))
    text = f"text struct<id:{id_type},n:bigint,key:binary>"
    searched = rows.mapInArrow(frugal(_search(words, percent, bits, HOT)), f"bucket bigint, keys binary, owners binary, b bigint, {text}")
    met = searched.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(frugal(_met), f"a bigint, b bigint, hot boolean, {text}")
    with watched_tables() as left:
        found = stored(met, "found")
        described = stored(found.where("text is not null").select("text.*").withColumnRenamed("id", "_id"), "described")
        full = described.where("n > 0")
        classes = full.groupBy("key").agg(F.min("_id").alias("_rep"), F.first("n").alias("n"))
        classes = stored(classes.withColumn("_handle", _handle_column()), "classes")
        release(spark, [])  # the keys of the search; Spark lets go of them once another job has run
        pairs = found.where("a is not null").select("a", "b", "hot").distinct()
        links = stored(_links(rows, classes, pairs, words, percent), "links")
        roots = connected_components(links).select(F.col("node").alias("key"), "root")
        linked = classes.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        smallest = linked.groupBy("root").agg(F.min("_rep").alias("component_id"))
        home = stored(linked.join(smallest, "root").select(F.col("key").alias("_key"), "component_id"), "home")
    release(spark, set(left) - {*paths_of(described), *paths_of(home)})
    placed = full.join(home.hint("merge"), F.col("key") == F.col("_key")).select("_id", "n", "component_id")
    alone = described.where("n = 0").select("_id", "n", F.col("_id").alias("component_id"))
    return placed.unionByName(alone).select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _handle_column():
    """The first eight bytes of ``key`` as a signed little-endian number, as ``handle`` has it."""
    parts = F.concat(*[F.substring("key", i, 1) for i in range(8, 0, -1)])
    return F.conv(F.hex(parts), 16, -10).cast("bigint")


def _groups(pairs: DataFrame) -> DataFrame:
    """``g`` and ``h``: the handles of classes that may be linked, by the smallest of them, itself included.

    A set that met the first of a crowded stretch joins all groups which that one is in.
    """
    met = pairs.where("not hot").select(F.col("a").alias("g"), F.col("b").alias("h"))
    hot = pairs.where("hot").select(F.col("a").alias("first"), F.col("b").alias("h"))
    through = met.withColumnRenamed("h", "first").join(hot, "first").select("g", "h")
    both = met.unionByName(hot.select(F.col("first").alias("g"), "h")).unionByName(through)
    return both.select("g", F.explode(F.array("g", "h")).alias("h")).distinct()


def _links(rows: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between classes, as few as connect them: keys ``a``, ``b``.

    First a class leaves the groups in which it can have no link (see ``_linkable``). Then every class meets one tile of its
    first group, and in each tile the first class of the group. Groups that did not lie in one tile are dealt once more
    with the class that has most links in each tile. Both take rows in proportion to the classes, and join a family
    of copies, also one whose members are only like their original. In groups that are still apart, classes outside the
    largest component (``loose``) meet all classes of the group; the rest of it is not multiplied with itself. All pairs
    that share a key are in one component, have been compared, or cannot be linked.
    """
    spark = rows.sparkSession
    named = _groups(pairs).join(classes.select(F.col("_handle").alias("h"), "key", "n", "_rep").hint("merge"), "h")
    named = stored(named.select("g", "h", "key", "n", "_rep"), "named")
    parts = named.groupBy("g").agg(F.ceil(F.sum("n") / BUCKET_GRAMS).cast("int").alias("parts"))
    placed = named.join(parts.hint("merge"), "g").groupBy("key", "_rep").agg(F.collect_list(F.struct("g", "parts")).alias("groups"))
    wanted = placed.select(F.col("_rep").alias("_r"), F.col("key").alias("_wanted"), "groups").hint("merge")
    # merge joins at every size: what is joined to the texts grows with them
    texts = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_r"))).select("_text", "_wanted", "groups")
    # rows that agree in id and set come more than once; the product takes them as one
    sets = "key binary, groups array<struct<g:bigint,parts:int>>, grams binary"
    sets = stored(texts.mapInArrow(frugal(_sets(words)), sets), "sets")
    _release_all(spark)  # the texts
    members = stored(_linkable(named, sets, percent), "members")
    _release_all(spark, paths_of(named))  # the n-grams of members

    first = members.groupBy("key").agg(F.min("g").alias("g"))
    once = _tiles(first, members.where("g = h").select("g", "key"))
    near = stored(_product(once, sets, percent), "near")
    whole, members = members, stored(members.join(_compared(once, members).hint("merge"), "g", "left_anti").select("g", "key"), "members")
    release(spark, paths_of(whole))
    # what follows reads only sets of groups that have not been compared
    whole, sets = sets, stored(sets.join(members.select("key").distinct().hint("merge"), "key", "left_semi"), "sets")
    release(spark, paths_of(whole))
    degree = near.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("links"))
    hubs = members.join(degree.hint("merge"), "key").groupBy("g").agg(F.max(F.struct("links", "key")).alias("hub")).select("g", "hub.key")
    first = members.groupBy("key").agg(F.min("g").alias("g"))
    near = stored(near.unionByName(_product(_tiles(first, hubs), sets, percent)), "near")
    roots = connected_components(near)
    placed, open_ = _open_groups(members, roots)
    release(spark, [])
    number = lambda c: F.ceil(c / TILE).cast("int")
    open_ = open_.select("g", number(F.col("all")).alias("tiles"), number(F.col("all") - F.col("top.n")).alias("loose"), F.col("top.root").alias("main"))
    rest = placed.join(open_.hint("merge"), "g").select("g", "key", "tiles", "loose", (F.col("root") != F.col("main")).alias("is_loose"), _tile().alias("j"))
    rest = rest.withColumn("i", F.pmod(F.xxhash64("key"), F.col("loose")).cast("int"))
    as_left = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: F.struct(F.col("i").alias("i"), t.alias("j"), F.when(t == F.col("j"), -1).otherwise(0).alias("side")),
    )
    as_right = F.transform(
        F.sequence(F.lit(0), F.col("loose") - 1), lambda t: F.struct(t.alias("i"), F.col("j").alias("j"), F.lit(1).alias("side"))
    )
    others = F.filter(as_right, lambda x: x["i"] != F.col("i"))
    at = F.explode(F.when(F.col("is_loose"), F.concat(as_left, others)).otherwise(as_right)).alias("at")
    again = rest.select("key", "g", at).select("key", F.concat_ws(":", "g", "at.i", "at.j").alias("block"), F.col("at.side").alias("side"))
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return stars.unionByName(_product(again, sets, percent))


def _linkable(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members (``g``, ``h``, ``key``) without those that can be linked with no other member of their group.

    What two sets share, other members hold too, so n-grams that no other member of the group holds add to no overlap. A
    member goes if the rest of its n-grams is less than the overlap that a link takes, with the smallest partner that its own
    size or the group allows. That costs a pass over the sets, however many members share a key. The n-grams of a group are
    counted in one place, those of a group of more than ``BUCKET_GRAMS`` in parts of that many: so a member is one row, or one
    for each part at most. Sets carry their ``groups``, so that they go to no shuffle but that of their n-grams. An n-gram that only
    seems shared, because hashes agree, keeps a member in; members are told apart by 64-bit hashes.
    """
    spark = members.sparkSession
    members = members.select("g", "h", "key", "n", F.xxhash64("g", "key").alias("id"))
    grams = members.agg(F.sum("n")).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(1, grams / BUCKET_GRAMS))))
    bounded_batches(spark)
    dealt = sets.select("key", "grams", F.explode("groups").alias("at")).select(F.xxhash64("at.g", "key").alias("id"), "at.g", "grams", "at.parts")
    scattered = dealt.mapInArrow(frugal(_scattered(bits)), "bucket bigint, keys binary, owners binary")
    unshared = scattered.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(frugal(_unshared), "id bigint, unshared bigint")
    unshared = unshared.groupBy("id").agg(F.sum("unshared").alias("unshared"))
    shared = F.col("n") - F.coalesce("unshared", F.lit(0))
    may_link = lambda partner: (100 + percent) * F.col("shared") >= percent * (F.col("n") + partner)
    left = members.join(unshared.hint("merge"), "id", "left").withColumn("shared", shared).where(may_link(F.ceil(percent * F.col("n") / 100)))
    sizes = left.groupBy("g").agg(F.count(F.lit(1)).alias("all"), F.min("n").alias("smallest"))
    return left.join(sizes.where("all > 1").hint("merge"), "g").where(may_link(F.col("smallest"))).select("g", "h", "key")


def _release_all(spark: SparkSession, paths: Iterable[str] = ()) -> None:
    """``release``, also of what the last job has shuffled: Spark refers to that until another job has run."""
    spark.range(1).count()
    release(spark, paths)


def _tile() -> Column:
    return F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")


def _tiles(members: DataFrame, heads: DataFrame) -> DataFrame:
    """Members (``g``, ``key``) dealt into tiles, with the head of the group, if it has one, in each."""
    sizes = members.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    dealt = members.join(sizes.hint("merge"), "g").select("key", "g", _tile().alias("i"))
    tiles = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i")
    once = dealt.unionByName(heads.join(sizes.hint("merge"), "g").select("key", "g", tiles)).distinct()
    return once.select("key", "g", F.concat_ws(":", "g", "i").alias("block"), F.lit(-1).alias("side"))


def _compared(once: DataFrame, members: DataFrame) -> DataFrame:
    """Groups (``g``) that lay in one tile as a whole, so that all their pairs have been compared."""
    dealt = once.groupBy("g").agg(F.count(F.lit(1)).alias("met"), F.min("block").alias("least"), F.max("block").alias("most"))
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("all"))
    return dealt.join(sizes.hint("merge"), "g").where("least = most and met = all").select("g")


def _open_groups(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with the ``root`` of their component, and groups that hold several, with their sizes and largest component."""
    roots = roots.select(F.col("node").alias("key"), "root")
    placed = members.select("g", "key").join(roots.hint("merge"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    placed = stored(placed, "placed")
    parts = placed.groupBy("g", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("g").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("top"))
    return placed, stored(sizes.where("parts > 1"), "open")


def _product(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links found in blocks of tiles, from ``key``, ``block`` and ``side``."""
    blocks = dealt.join(sets.hint("merge"), "key").select("block", "side", "key", "grams").repartition("block").sortWithinPartitions("block")
    return blocks.mapInArrow(frugal(_multiply(percent)), "a binary, b binary")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; blank texts all stay.

    Rows that agree in id count as one document and stay or go together.
    """
    with watched_tables() as left:
        found = near_components(docs, id_col, text_col, words, percent)
        gone = stored(found.where(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_gone")).distinct(), "gone")
    release(docs.sparkSession, set(left) - set(paths_of(gone)))
    return docs.join(gone.hint("merge"), docs[id_col] == F.col("_gone"), "left_anti")


@query(
    "op10_ngram_join",
    r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, list_filter(
            string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
            lambda x: x <> '') AS w
        FROM documents
    ), grams AS (
        SELECT doc_id, unnest(list_distinct(list_transform(
            range(1, greatest(len(w) - 1, 2)), lambda i: array_to_string(w[i:i + 2], ' ')))) AS g
        FROM texts WHERE len(w) > 0
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
    ), shared AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
        SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM texts
        UNION SELECT r.a, l.y FROM reach r JOIN links l ON l.x = r.b
    )
    SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
    FROM reach LEFT JOIN sizes ON doc_id = a GROUP BY a
    """,
)
def op10_ngram_join(spark, folder):
    return near_components(table(spark, folder, "documents", "doc_id", "text"))
