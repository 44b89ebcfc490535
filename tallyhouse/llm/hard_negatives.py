"""Hard negatives by exact search in an inverted multi-index of two half spaces."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.config import stored
from tallyhouse.llm.common import drawn
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

# Codewords of each half; cells are pairs of them.
CODES = 32
# Rows that the codebooks are fitted on, and rounds of fitting. Every row is indexed.
SAMPLE_ROWS, FIT_ROUNDS = 8192, 8
# Rows of a block and anchors of a group: one task holds one block and takes the anchors of one group.
BLOCK_ROWS, GROUP_ANCHORS = 8192, 4096
# Rows of cells that are scored together.
CHUNK = 512
POSITIVES, NEGATIVES = 5, 3
# Whole numbers whose products a double adds up exactly.
EXACT = 2**52

FOUND = "anchor_id bigint, slot int, id bigint, score bigint"
SENT = "block int, part int, kind int, id bigint, label bigint, vec binary, c1 int, c2 int, floor bigint, lows array<bigint>, highs array<bigint>"


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id``, ``label`` and ``v``: components times 256, rounded down.

    Rows with a null id, label or vector, or a null or non-finite component are left out; rows
    that agree in all three count once.
    """
    v = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(vectors[id_col].cast("bigint").alias("id"), vectors[label_col].cast("bigint").alias("label"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    return rows.select("id", "label", F.transform("v", lambda x: F.floor(x * 256)).alias("v")).distinct()


class Codebooks:
    """Two sets of codewords, one for each half of the components; shorter vectors are filled up with zeros."""

    def __init__(self, dims: int, first: np.ndarray, second: np.ndarray) -> None:
        self.dims, self.half, self.words = dims, dims // 2, (first, second)

    def halves(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return m[:, : self.half], m[:, self.half :]

    def assign(self, m: np.ndarray) -> list[np.ndarray]:
        return [nearest(x, w) for x, w in zip(self.halves(m), self.words, strict=True)]


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words**2).sum(1)[None, :] - 2 * (x @ words.T)).argmin(1)


def fit(sample: np.ndarray, codes: int = CODES) -> Codebooks:
    """Codebooks of a bounded sample: the first distinct halves, then rounds of moving words to the means of what is nearest."""
    half, out = sample.shape[1] // 2, []
    for x in (sample[:, :half], sample[:, half:]):
        words = np.unique(x, axis=0)
        words = words[np.random.default_rng(0).permutation(len(words))[:codes]].astype(float)
        for _ in range(FIT_ROUNDS):
            at = nearest(x, words)
            counts = np.bincount(at, minlength=len(words))
            for k in np.flatnonzero(counts):
                words[k] = x[at == k].mean(0)
        out.append(words)
    return Codebooks(sample.shape[1], *out)


def packed(m: np.ndarray) -> list[bytes]:
    """Rows as bytes of the narrowest whole numbers that hold them all."""
    most = max(int(m.max()), -int(m.min())) if m.size else 0
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if most < 1 << (8 * int(k[2]) - 1) or k == "<i8")
    return [r.tobytes() for r in m.astype(kind)]


def unpacked(data: list[bytes], dims: int) -> np.ndarray:
    """Rows as whole numbers of 64 bits, whatever the width they were packed in."""
    out = np.zeros((len(data), dims), np.int64)
    if dims:
        widths = np.array([len(d) // dims for d in data])
        for w in np.unique(widths):
            at = np.flatnonzero(widths == w)
            out[at] = np.frombuffer(b"".join(data[i] for i in at), f"<i{w}").reshape(-1, dims)
    return out


def _coded(books: Codebooks):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.zeros((batch.num_rows, books.dims), np.int64)
            for i, v in enumerate(batch.column(2).to_pylist()):
                m[i, : len(v)] = v
            codes = books.assign(m.astype(float))
            far = [np.sqrt(((x - w[c]) ** 2).sum(1)) for x, w, c in zip(books.halves(m.astype(float)), books.words, codes, strict=True)]
            arrays = [pa.array(packed(m), pa.binary()), *[pa.array(c, pa.int32()) for c in codes], *[pa.array(f) for f in far]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["id", "label", "vec", "c1", "c2", "r1", "r2"])

    return coded


class Cells:
    """Bounds of the score of an anchor with any row of a cell, summed from those of its halves.

    A half score is at most that with the codeword plus the length of the anchor's half times the
    largest distance of a row from the codeword.
    """

    def __init__(self, books: Codebooks, used: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray]) -> None:
        self.books, self.used, self.radii = books, used, radii

    def bounds(self, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Upper and lower bounds of the two halves for the used codewords; one row per anchor."""
        high, low = [], []
        for x, words, used, r in zip(self.books.halves(q), self.books.words, self.used, self.radii, strict=True):
            middle, slack = x @ words[used].T, np.sqrt((x**2).sum(1))[:, None] * r[used][None, :]
            room = 1e-9 * (np.abs(middle) + slack) + 1e-6
            high.append(middle + slack + room)
            low.append(middle - slack - room)
        return high, low


class Block:
    """The rows of one block by cell, and the search in them."""

    def __init__(self, books: Codebooks, rows: list[tuple]) -> None:
        ids, labels, data, c1, c2 = zip(*rows, strict=True)
        codes = np.array([c1, c2])
        order = np.lexsort((codes[1], codes[0]))
        self.ids, self.labels = np.array(ids, np.int64)[order], np.array(labels, np.int64)[order]
        whole = unpacked([data[i] for i in order], books.dims)
        codes = codes[:, order]
        self.exact = not whole.size or int(np.abs(whole).max()) ** 2 * books.dims < EXACT
        self.rows = whole.astype(float) if self.exact else whole
        used, radii, place = [], [], []
        for c, x, words in zip(codes, books.halves(whole.astype(float)), books.words, strict=True):
            far = np.sqrt(((x - words[c]) ** 2).sum(1))
            r = np.zeros(len(words))
            np.maximum.at(r, c, far)
            used.append(np.unique(c))
            radii.append(r)
            place.append(np.searchsorted(used[-1], c))
        self.cells = Cells(books, tuple(used), tuple(radii))
        self.grid = {}
        starts = np.flatnonzero(np.r_[True, (np.diff(place[0]) != 0) | (np.diff(place[1]) != 0)])
        for s, e in zip(starts, np.r_[starts[1:], len(order)], strict=True):
            self.grid[int(place[0][s]), int(place[1][s])] = (int(s), int(e))

    def scores(self, q: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        at = np.concatenate([np.arange(s, e) for s, e in spans])
        return at, (self.rows[at] @ q).astype(np.int64)

    def visit(self, q: np.ndarray, high: list[np.ndarray], low: list[np.ndarray], top: float, needed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores, cell after cell in descending order of the bound, until ``needed()`` is above it.

        The cells are taken from a heap that starts at the best pair of codewords and gets, for each
        pair taken, its two neighbours in the sorted halves. Cells that lie above ``top`` as a whole are left out.
        """
        if not self.exact:
            yield self.scores(q, [(0, len(self.ids))])
            return
        o1, o2 = np.argsort(-high[0], kind="stable").tolist(), np.argsort(-high[1], kind="stable").tolist()
        h1, h2, l1, l2 = high[0].tolist(), high[1].tolist(), low[0].tolist(), low[1].tolist()
        heap, spans, held = [(-(h1[o1[0]] + h2[o2[0]]), 0, 0)], [], 0
        while heap:
            bound, i, j = heap[0]
            if -bound < needed():
                break
            heapq.heappop(heap)
            if j == 0 and i + 1 < len(o1):
                heapq.heappush(heap, (-(h1[o1[i + 1]] + h2[o2[0]]), i + 1, 0))
            if j + 1 < len(o2):
                heapq.heappush(heap, (-(h1[o1[i]] + h2[o2[j + 1]]), i, j + 1))
            cell = self.grid.get((o1[i], o2[j]))
            if cell and l1[o1[i]] + l2[o2[j]] <= top:
                spans.append(cell)
                held += cell[1] - cell[0]
            if held >= CHUNK:
                yield self.scores(q, spans)
                spans, held = [], 0
        if spans:
            yield self.scores(q, spans)

    def positives(self, me: int, label: int, q: np.ndarray, high, low, floor: int) -> list[tuple[int, int]]:
        """The best rows of the anchor's label, by score, then id: (score, id)."""
        best: list[tuple[int, int]] = []
        least = lambda: max(floor, best[-1][0]) if len(best) == POSITIVES else floor
        for at, s in self.visit(q, high, low, math.inf, least):
            fits = np.flatnonzero((self.labels[at] == label) & (self.ids[at] != me) & (s >= least()))
            if len(fits):
                best = ranked(best, s[fits], self.ids[at[fits]], POSITIVES)
        return best

    def negatives(self, label: int, q: np.ndarray, high, low, lows: list[int], highs: list[int]) -> list[list[tuple[int, int]]]:
        """For each window the best rows of other labels inside it."""
        best: list[list[tuple[int, int]]] = [[] for _ in lows]
        floors, top = list(lows), max(highs)
        least = lambda: min(floors)
        for at, s in self.visit(q, high, low, top, least):
            fits = np.flatnonzero((self.labels[at] != label) & (s >= least()) & (s <= top))
            if not len(fits):
                continue
            s, ids = s[fits], self.ids[at[fits]]
            for k, (lo, hi) in enumerate(zip(floors, highs, strict=True)):
                inside = (s >= lo) & (s <= hi)
                if inside.any():
                    best[k] = ranked(best[k], s[inside], ids[inside], NEGATIVES)
                    if len(best[k]) == NEGATIVES:
                        floors[k] = max(lo, best[k][-1][0])
        return best


def ranked(best: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, most: int) -> list[tuple[int, int]]:
    first = np.lexsort((ids, -scores))[:most]
    return sorted([*best, *zip(scores[first].tolist(), ids[first].tolist(), strict=True)], key=lambda x: (-x[0], x[1]))[:most]


def _searched(books: Codebooks):
    """Rows sorted by block, group of anchors and kind: first the rows of the block, then the anchors, in batches."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, block = None, [], None
        for batch in batches:
            names, found = batch.schema.names, []
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(names)}
            keys = list(zip(columns["block"], columns["part"], strict=True))
            asking: dict[tuple[int, int], list[int]] = {}
            for i, key in enumerate(keys):
                if columns["kind"][i]:
                    asking.setdefault(key, []).append(i)
            bounds = None
            for i, key in enumerate(keys):
                if key != current:
                    current, rows, block, bounds = key, [], None, None
                if not columns["kind"][i]:
                    rows.append(tuple(columns[c][i] for c in ("id", "label", "vec", "c1", "c2")))
                    continue
                if not rows and block is None:
                    continue
                if block is None:
                    block, rows = Block(books, rows), []
                if bounds is None:
                    q, first = unpacked([columns["vec"][j] for j in asking[key]], books.dims), i
                    bounds = block.cells.bounds(q.astype(float))
                n, me, label = i - first, columns["id"][i], columns["label"][i]
                high, low = [b[n] for b in bounds[0]], [b[n] for b in bounds[1]]
                x = q[n].astype(float) if block.exact else q[n]
                if columns["lows"][i] is None:
                    found += [(me, 0, d, s) for s, d in block.positives(me, label, x, high, low, columns["floor"][i])]
                else:
                    lists = block.negatives(label, x, high, low, columns["lows"][i], columns["highs"][i])
                    found += [(me, k, d, s) for k, one in enumerate(lists) for s, d in one]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            arrays = [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor_id", "slot", "id", "score"])

    return searched


def _routed(cells: Cells, blocks: dict[tuple[int, int], list[int]], home: bool):
    """Each anchor with the blocks that may hold what it seeks: the one of its best cell, or all but that one."""
    where = list(blocks)
    one, two = (np.searchsorted(u, [c[k] for c in where]) for k, u in enumerate(cells.used))
    books, lists = cells.books, [blocks[c] for c in where]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            q = unpacked(batch.column(names.index("vec")).to_pylist(), books.dims).astype(float)
            high, low = cells.bounds(q)
            top, bottom = high[0][:, one] + high[1][:, two], low[0][:, one] + low[1][:, two]
            floors = batch.column(names.index("floor")).to_pylist()
            highs = batch.column(names.index("highs")).to_pylist()
            rows, to = [], []
            for i, best in enumerate(top.argmax(1)):
                first = lists[best][0]
                if home:
                    found = [first]
                else:
                    fits = (top[i] >= floors[i]) & (bottom[i] <= (max(highs[i]) if highs[i] else math.inf))
                    found = sorted({b for c in np.flatnonzero(fits) for b in lists[c]} - {first})
                rows += [i] * len(found)
                to += found
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *out.columns], ["block", *names])

    return routed


def _search(index: DataFrame, anchors: DataFrame, cells: Cells, blocks: dict, parts: int, home: bool) -> DataFrame:
    """What the anchors find, block by block: ``FOUND`` rows.

    A pair of a block and a group of anchors is one unit of work, so neither a common cell nor many
    anchors near it make a task longer; a block goes to those groups that ask for it.
    """
    kind = "block int, id bigint, label bigint, vec binary, part int, floor bigint, lows array<bigint>, highs array<bigint>"
    asked = anchors.select("id", "label", "vec", "part", "floor", "lows", "highs").mapInArrow(_routed(cells, blocks, home), kind)
    if not home:
        asked = stored(asked, "asked")
        wanted = asked.select("block", "part").distinct()
    else:
        wanted = index.sparkSession.range(parts).select(F.col("id").cast("int").alias("part")).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(max(max(b) for b in blocks.values()))))
        )
    given = index.join(wanted.hint("merge"), "block")
    none = F.lit(None)
    rows = given.select(
        "block", "part", F.lit(0).alias("kind"), "id", "label", "vec", "c1", "c2", none.cast("bigint").alias("floor"),
        none.cast("array<bigint>").alias("lows"), none.cast("array<bigint>").alias("highs"),
    ).unionByName(
        asked.select("block", "part", F.lit(1).alias("kind"), "id", "label", "vec", none.cast("int").alias("c1"), none.cast("int").alias("c2"), "floor", "lows", "highs")
    )
    rows = rows.repartition("block", "part").sortWithinPartitions("block", "part", "kind")
    return rows.mapInArrow(_searched(cells.books), FOUND)


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first of what blocks returned, each at most ``most`` rows for an anchor and slot."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 50
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Rows whose id is divisible by ``every`` are anchors, searched against all rows. Scores are inner
    products of the vectors that ``whole_vectors`` gives; missing components of a shorter vector
    count as 0; products beyond a long wrap. An anchor's positives are the first five other rows of its label; a positive's negatives
    the first three rows of other labels with scores from half of its score to 95 % of it. Higher scores come first, then
    smaller ids. Rows that agree in all columns count once; several rows of one id are all searched, and an anchor id
    with several is asked with the smallest label and vector. Extra columns are left out; an empty table gives an empty one.

    Codebooks are fitted on ``SAMPLE_ROWS`` rows, every row is indexed, and cells are left out only where a
    bound proves that they hold nothing, so the result is exact. An anchor first asks the block of
    its best cell, and then those blocks that might better what it found there.
    """
    spark = vectors.sparkSession
    rows = stored(whole_vectors(vectors, id_col, vector_col, label_col), "vectors")
    total, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not total:
        return spark.createDataFrame([], empty)
    dims = max(dims, 2)  # a component for each half
    sample = rows.where(drawn(F.col("id"), SAMPLE_ROWS, total)).orderBy(F.xxhash64("id"), "id", "label", "v").limit(SAMPLE_ROWS).select("v").toArrow()
    learned = np.zeros((max(1, sample.num_rows), dims))
    for i, v in enumerate(sample.column(0).to_pylist()):
        learned[i, : len(v)] = v
    books = fit(learned)
    coded = rows.mapInArrow(_coded(books), "id bigint, label bigint, vec binary, c1 int, c2 int, r1 double, r2 double")
    coded = stored(coded, "coded")

    # one row per cell, at most CODES * CODES whatever the number of rows
    stats = coded.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
    radii = tuple(np.zeros(len(w)) for w in books.words)
    blocks, filled, at = {}, 0, 0
    cuts = []
    for s in sorted(stats, key=lambda s: (s["c1"], s["c2"])):
        radii[0][s["c1"]], radii[1][s["c2"]] = max(radii[0][s["c1"]], s["r1"]), max(radii[1][s["c2"]], s["r2"])
        if filled and filled + s["n"] > BLOCK_ROWS:
            at, filled = at + 1, 0
        pieces = math.ceil(s["n"] / BLOCK_ROWS)
        blocks[s["c1"], s["c2"]] = list(range(at, at + pieces))
        cuts.append((s["c1"], s["c2"], at, pieces))
        at, filled = (at, filled + s["n"]) if pieces == 1 else (at + pieces, 0)
    cells = Cells(books, tuple(np.unique([s[c] for s in stats]) for c in ("c1", "c2")), radii)
    places = F.broadcast(spark.createDataFrame(cuts, "c1 int, c2 int, at int, pieces int"))
    block = (F.col("at") + F.pmod(F.xxhash64("id", "label", "vec"), F.col("pieces"))).cast("int")
    index = stored(coded.join(places, ["c1", "c2"]).select("id", "label", "vec", "c1", "c2", block.alias("block")), "index")

    anchors = coded.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")
    parts = max(1, math.ceil(anchors.count() / GROUP_ANCHORS))
    anchors = stored(anchors.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")), "anchors")
    nowhere, lists = F.lit(-(2**62)), F.lit(None).cast("array<bigint>")

    def both(asking: DataFrame, wanted: int, floor_of) -> DataFrame:
        """The home blocks first, then the others with the floors found there."""
        near = stored(_first(_search(index, asking, cells, blocks, parts, True), wanted).drop("rank"), "near")
        again = floor_of(asking, near)
        far = _search(index, again, cells, blocks, parts, False)
        return stored(_first(near.unionByName(far), wanted), "found")

    def better_positives(asking: DataFrame, near: DataFrame) -> DataFrame:
        full = near.groupBy(F.col("anchor_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        return asking.drop("floor").join(full, "id", "left").withColumn("floor", F.when(F.col("n") == POSITIVES, F.col("least")).otherwise(nowhere))

    positives = both(anchors.withColumns({"floor": nowhere, "lows": lists, "highs": lists}), POSITIVES, better_positives)
    windows = positives.select(
        "anchor_id", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.expr("score div 2 + score % 2").alias("low"), F.expr("score div 100 * 95 + score % 100 * 95 div 100").alias("high"),
    ).where("positive_score >= 0 and low <= high")
    windows = stored(windows, "windows")
    in_order = F.array_sort(F.collect_list(F.struct("place", "low", "high")))
    listed = windows.groupBy(F.col("anchor_id").alias("id")).agg(in_order.alias("w")).select(
        "id", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"), F.array_min("w.low").alias("floor")
    )

    def better_negatives(asking: DataFrame, near: DataFrame) -> DataFrame:
        full = near.groupBy(F.col("anchor_id").alias("id"), "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        full = full.where(F.col("n") == NEGATIVES).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "least"))).alias("least"))
        lows = F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("least", i), x)))
        return asking.join(full, "id", "left").withColumn("lows", lows).withColumn("floor", F.array_min("lows"))

    negatives = both(stored(anchors.join(listed, "id"), "asking"), NEGATIVES, better_negatives)
    slots = windows.withColumn("slot", (F.row_number().over(Window.partitionBy("anchor_id").orderBy("place")) - 1).cast("int"))
    return negatives.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(slots, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


ORACLE = """
WITH rows AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query("op11_hard_negatives", ORACLE)
def op11_hard_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", shifted))
