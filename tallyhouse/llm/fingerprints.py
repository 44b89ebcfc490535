"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.config import paths_of, release, stored, watched_tables
from tallyhouse.llm.common import ranges_for, with_starts
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

# Cells of a sketch, in three parts; a digest lies in one cell of each part.
PART = 12
CELLS = 3 * PART
# Smallest digests of each side by which the size of a difference is estimated; cells per part for each differing
# digest, and in addition.
LEAST = 16
ROOM, SPARE = 0.8, 4
# Digests of both sides of a row above which it is cut into pieces; rounds after which a sketch counts as too small.
PIECE, ROUNDS = 2048, 9
# Digests that are peeled in one task, so that the aggregates of all rounds have room in its memory.
TASK_DIGESTS = 100_000
PIECE_KEYS = ["_no", "_p"]
# A line longer than this is cut at the ends of its sentences: every line.
LONG_LINE = 0

CELL = "struct<c:bigint,k:bigint,h:bigint>"
EMPTY = f"cast(named_struct('c', 0, 'k', 0, 'h', 0) as {CELL})"


def paragraph_digests(text: Column) -> Column:
    """The distinct 64-bit digests of the paragraphs of a text: the sentences of its lines.

    Blank paragraphs do not count; null is empty.
    """
    lines = F.split(F.coalesce(text, F.lit("")), r"\n+")
    parts = F.flatten(
        F.transform(lines, lambda x: F.when(F.length(x) > LONG_LINE, F.split(x, r"(?<=[.!?])\s+")).otherwise(F.array(x)))
    )
    return F.array_distinct(F.transform(F.filter(parts, lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))


def _check(key: str) -> str:
    return f"xxhash64({key}, 'check')"


def _place(key: str, part: int) -> str:
    return f"{part * PART} + pmod(xxhash64({key}, {part}), {PART})"


def _items(digests: str) -> str:
    fields = ", ".join(f"'p{i}', {_place('d', i)}" for i in range(3))
    return f"transform({digests}, d -> named_struct('k', d, 'h', {_check('d')}, {fields}))"


def sketch(digests: str) -> Column:
    """The cells of a set of digests: how many digests lie there, and the xor of them and of their checks."""
    more = f"cast(named_struct('c', a.c + 1, 'k', a.k ^ e.k, 'h', a.h ^ e.h) as {CELL})"
    parts = ", ".join(
        f"transform(sequence({p * PART}, {p * PART + PART - 1}), i -> aggregate(x.items, {EMPTY}, (a, e) -> if(e.p{p} = i, {more}, a)))"
        for p in range(3)
    )
    # the items are bound once by a transform over one element
    return F.expr(f"transform(array(named_struct('items', {_items(digests)})), x -> concat({parts}))[0]")


def written(cells: Column) -> Column:
    """A sketch as text: per cell 4, 16 and 8 hexadecimal digits of count, digests and checks."""
    return F.array_join(
        F.transform(
            cells,
            lambda c: F.concat(
                F.lpad(F.hex(c["c"]), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["h"].bitwiseAND(0xFFFFFFFF)), 8, "0")
            ),
        ),
        "",
    )


def estimated_difference(a: str, b: str) -> Column:
    """About how many digests one side holds alone, from the ``LEAST`` smallest of both sides."""
    least = "slice(array_sort({}), 1, " + str(LEAST) + ")"
    low = f"named_struct('a', {least.format(a)}, 'b', {least.format(b)})"
    both = f"transform(array({low}), s -> named_struct('all', {least.format('array_union(s.a, s.b)')}, 'both', array_intersect(s.a, s.b)))[0]"
    share = f"transform(array({both}), s -> try_divide(size(array_intersect(s.all, s.both)), size(s.all)))[0]"
    return F.expr(f"transform(array(coalesce({share}, 1D)), j -> cast(ceil((size({a}) + size({b})) * (1 - j) / (1 + j)) as int))[0]")


def _place_of(digest: str, part: int) -> str:
    """The cell of a digest in one part of a sketch of three parts of ``_m`` cells."""
    return f"cast(pmod(xxhash64({digest}, {part}, _m), _m) + _m * {part} as int)"


def _folded(cells: DataFrame) -> DataFrame:
    """Cells of a piece summed up, and digests found (``f``) as they are; cells that nothing is left in are gone."""
    sums = [F.expr(f"{how}({c}) as {c}") for how, c in (("sum", "c"), ("bit_xor", "k"), ("bit_xor", "h"))]
    return cells.groupBy(*PIECE_KEYS, "_m", "cell", "f").agg(*sums).where("f is not null or c <> 0 or k <> 0 or h <> 0")


def _round(cells: DataFrame, part: int) -> DataFrame:
    """Take the digests that lie alone in a cell of one part out of their other cells.

    A digest is in one cell of a part, so it is found once; its check and its place tell that it is alone.
    """
    cell = "named_struct('cell', {}, 'c', {}, 'k', {}, 'h', {}, 'f', {})"
    alone = f"abs(c) = 1 and f is null and cell = {_place_of('k', part)} and h = hash(k, 'check')"
    taken = [cell.format(_place_of("k", p), "-c", "k", "h", "cast(null as bigint)") for p in range(3) if p != part]
    found = cell.format("-1", "c", "0L", "0", "k")
    kept = cell.format("cell", "c", "k", "h", "f")
    after = f"explode(if({alone}, array({found}, {', '.join(taken)}), array({kept}))) as _c"
    return _folded(cells.selectExpr(*PIECE_KEYS, "_m", after).selectExpr(*PIECE_KEYS, "_m", "_c.*"))


def peeled(pieces: DataFrame) -> DataFrame:
    """Peel the difference of two sketches per row of ``_no``, ``_p``, ``_m`` (cells of a part), ``_a`` and ``_b``.

    Rows with a digest found (``f``, and ``c``: 1 on the left, -1 on the right) or, without ``f``, a cell that could not
    be peeled. Both sketches are linear: cells of the left count up, those of the right down, and equal digests cancel out.
    The cells of a piece lie together, so all rounds run in one stage and nothing is stored between them.
    """
    side = "transform({}, d -> named_struct('k', d, 'c', {}L))"
    signed = F.explode(F.expr(f"concat({side.format('_a', 1)}, {side.format('_b', -1)})")).alias("_d")
    digests = pieces.agg(F.sum(F.size("_a") + F.size("_b"))).first()[0] or 0
    dealt = pieces.repartition(max(ranges_for(pieces), digests // TASK_DIGESTS), *PIECE_KEYS).select(*PIECE_KEYS, "_m", signed).select(*PIECE_KEYS, "_m", "_d.k", "_d.c")
    places = F.expr(f"explode(array({', '.join(_place_of('k', p) for p in range(3))})) as cell")
    dealt = dealt.withColumn("h", F.hash("k", F.lit("check"))).select(*PIECE_KEYS, "_m", places, "c", "k", "h", F.lit(None).cast("bigint").alias("f"))
    return reduce(lambda cells, i: _round(cells, i % 3), range(ROUNDS), _folded(dealt))


def _pieces(sets: DataFrame) -> DataFrame:
    """Rows of ``_no``, ``_a`` and ``_b`` with at most ``PIECE`` digests as they are, larger ones cut by a hash of the digest.

    A digest that both sides hold lies in one piece (``_p``), so the differences of the pieces add up to those of the row.
    """
    total = F.size("_a") + F.size("_b")
    small = sets.where(total <= PIECE).select("_no", F.lit(0).cast("bigint").alias("_p"), "_a", "_b")
    side = "transform({}, d -> named_struct('k', d, 'c', {}))"
    signed = F.explode(F.expr(f"concat({side.format('_a', 1)}, {side.format('_b', -1)})")).alias("_d")
    digests = sets.where(total > PIECE).select("_no", F.ceil(total / F.lit(PIECE / 2)).alias("_cuts"), signed)
    digests = digests.select("_no", F.pmod(F.xxhash64("_d.k", F.lit("piece")), F.col("_cuts")).alias("_p"), "_d.k", "_d.c")
    sides = [F.collect_list(F.when(F.col("c") == c, F.col("k"))).alias(n) for c, n in ((1, "_a"), (-1, "_b"))]
    return small.unionByName(digests.groupBy(*PIECE_KEYS).agg(*sides))


def changed_digests(sets: DataFrame, what: list[Column]) -> DataFrame:
    """Per piece of a row of ``_no`` (a key), ``_a`` and ``_b`` with a difference: ``_no``, and ``what`` as aggregates of ``peeled``.

    The first sketch of a piece is as large as an estimate of its difference asks for. Where it is too small all the
    same, the piece is sketched again in twice the cells, until all have given way.
    """
    width = F.ceil(estimated_difference("_a", "_b") * ROOM).cast("int") + SPARE
    left, parts = _pieces(sets).withColumn("_m", width), []
    while True:
        release(sets.sparkSession, [])
        tried = peeled(left).groupBy(*PIECE_KEYS).agg((F.count("f") < F.count(F.lit(1))).alias("failed"), *what)
        tried = stored(tried, "changes")
        parts.append(tried.where("not failed").drop("failed", "_p"))
        failed = tried.where("failed").select(*PIECE_KEYS)
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, parts)
        left = stored(left.join(failed.hint("merge"), PIECE_KEYS).withColumn("_m", F.col("_m") * 2), "sets")


def paragraph_changes(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Add ``only_left`` and ``only_right``: the digests that one of two digest arrays holds alone.

    Found from sketches alone (see ``changed_digests``): what both sides hold cancels out. Arrays hold
    distinct digests; null counts as empty. Rows keep their columns; columns of the two names are
    replaced. An empty table gives an empty table.
    """
    names = [c for c in pairs.columns if c not in ("only_left", "only_right")]
    none = F.expr("cast(array() as array<bigint>)")
    rows = pairs.select(
        F.struct(*names).alias("_row"), F.coalesce(F.col(left), none).alias("_a"), F.coalesce(F.col(right), none).alias("_b"),
        F.monotonically_increasing_id().alias("_no"),
    )
    rows = stored(rows, "pairs")
    changes = changed_digests(rows.select("_no", "_a", "_b"), [F.collect_list(F.when(F.col("c") == c, F.col("f"))).alias(f"only_{n}") for c, n in ((1, "left"), (-1, "right"))])
    changes = changes.groupBy("_no").agg(*[F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in ("only_left", "only_right")])
    out = rows.join(changes.hint("merge"), "_no", "left")
    return out.select("_row.*", *[F.coalesce(c, none).alias(c) for c in ("only_left", "only_right")])


def likeness(left: Column, right: Column, only_left: Column, only_right: Column) -> Column:
    """Shared paragraphs over all paragraphs of two documents; two empty ones are alike."""
    total, apart = F.size(left) + F.size(right), F.size(only_left) + F.size(only_right)
    return F.when(total == 0, F.lit(1.0)).otherwise((total - apart) / (total + apart).cast("double"))


def fingerprint(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``paragraphs`` (distinct digests) and ``fingerprint`` (the sketch as text).

    Equal texts have equal fingerprints; null and blank texts have the empty one. Columns of
    these names are replaced.
    """
    rows = docs.withColumn("paragraphs", paragraph_digests(docs[text_col]))
    return rows.withColumn("fingerprint", written(sketch("paragraphs")))


def with_next_edited(docs: DataFrame) -> DataFrame:
    """``rank``, ``next_rank``, ``doc_id``, ``text`` and ``edited``: the last third replaced by the front of the next document.

    Documents follow each other by falling ``doc_id``, null last; those of one id by falling hash of the text. Rows that
    agree in id and text are one document (one ``rank``) in that order, and each of them is returned.
    Texts are shuffled once, by id; only the front that the predecessor needs moves a second time.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_h"))
    ids = docs.groupBy("doc_id", "_h").agg(F.floor(F.max(F.char_length("text")) / 3).cast("int").alias("k"))
    ids = stored(ids, "ids")
    ranked = stored(with_starts(ids, [F.col("doc_id"), F.col("_h")], {"rank": F.lit(1)}, ranges_for(ids)), "ranked")
    last = ranked.agg(F.max("rank")).first()[0] or 0
    def known(id_: str, none: str, h: str) -> list[Column]:
        return [F.coalesce("doc_id", F.lit(0)).alias(id_), F.col("doc_id").isNull().alias(none), F.col("_h").alias(h)]

    takers = ranked.select(
        F.when(F.col("rank") == 0, F.lit(last)).otherwise(F.col("rank") - 1).alias("rank"), F.col("k").alias("_give"), *known("_fi", "_fn", "_fh")
    )
    given = stored(ranked.join(takers, "rank").select(*known("_id", "_none", "_h"), "rank", "_give", "_fi", "_fn", "_fh"), "given")
    both = docs.select("text", *known("_id", "_none", "_h")).join(given.hint("merge"), ["_id", "_none", "_h"])
    # whole texts keep the place that the join gave them
    fronts = both.select("_fi", "_fn", "_fh", F.col("rank").alias("next_rank"), F.expr("substring(text, 1, _give)").alias("front"))
    fronts = fronts.dropDuplicates(["_fi", "_fn", "_fh"])
    whole = both.select("rank", F.when(~F.col("_none"), F.col("_id")).alias("doc_id"), "text", "_id", "_none", "_h")
    same = (F.col("_id") == F.col("_fi")) & (F.col("_none") == F.col("_fn")) & (F.col("_h") == F.col("_fh"))
    joined = whole.join(fronts.hint("merge"), same)
    kept = F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) as int))")
    return joined.select("rank", "next_rank", "doc_id", "text", F.concat(kept, F.col("front")).alias("edited"))


@query("op4_fingerprints")
def op4_fingerprints(spark, folder):
    with watched_tables() as made:
        versions = with_next_edited(table(spark, folder, "documents", "doc_id", "text"))
        rows = stored(
            versions.select(
                "rank",
                "next_rank",
                "doc_id",
                F.char_length("text").cast("bigint").alias("n_chars"),
                F.sha2("edited", 256).alias("edited_sha256"),
                paragraph_digests(F.col("text")).alias("own"),
                paragraph_digests(F.col("edited")).alias("other"),
            ),
            "versions",
        )
    release(spark, set(made) - set(paths_of(rows)))
    single = rows.select("rank", "next_rank", "own", "other").dropDuplicates(["rank"])
    following = single.select(F.col("rank").alias("next_rank"), F.col("own").alias("_b"))
    sets = single.select((F.col("rank") * 2).alias("_no"), F.col("own").alias("_a"), F.col("other").alias("_b")).unionByName(
        single.select("rank", "next_rank", "own").join(following.hint("merge"), "next_rank").select((F.col("rank") * 2 + 1).alias("_no"), F.col("own").alias("_a"), "_b")
    )
    sets = stored(sets, "sets")
    release(spark, [])  # the shuffled texts; Spark lets go of them once another job has run
    apart = changed_digests(sets, [F.count("f").alias("apart")]).groupBy("_no").agg(F.sum("apart").alias("apart"))
    near = sets.select("_no", (F.size("_a") + F.size("_b")).alias("total")).join(apart.hint("merge"), "_no", "left")
    near = near.withColumn("apart", F.coalesce("apart", F.lit(0)))
    share = (F.col("total") - F.col("apart")) / (F.col("total") + F.col("apart")).cast("double")
    near = near.select(
        F.floor(F.col("_no") / 2).alias("rank"), (F.col("_no") % 2).alias("kind"), F.when(F.col("total") == 0, F.lit(1.0)).otherwise(share).alias("near")
    ).groupBy("rank").agg(*[F.max(F.when(F.col("kind") == i, F.col("near"))).alias(f"near_{k}") for i, k in enumerate(("edited", "next"))])
    return rows.join(near.hint("merge"), "rank").select(
        "doc_id", "n_chars", "edited_sha256",
        written(sketch("own")).alias("fingerprint"), written(sketch("other")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
