"""Prefix trie of conversations: union-find over neighbours in sorted order, ranges merged across their borders."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyhouse.config import stored
from tallyhouse.llm.common import ranges_for, with_starts
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

# Turns of a segment: longer conversations are cut, and the tries of their segments are put on top of each other.
SEGMENT = 1024
# Classes and bytes that one union-find holds at a time, and ids of one piece of a list of ends.
RUN_ROWS, RUN_BYTES = 20_000, 32 << 20
PIECE = 4096
# Width of the digest of a turn.
WIDTH = 16
ROOT_END = b"root"
NODE = "struct<open:int,key:binary,depth:bigint,conv:bigint,parent:bigint,parent_key:binary,n:bigint,children:bigint,leaves:bigint,saved:bigint,cid:binary,deeper:binary>"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``at`` (a running number over all conversations in order), ``digest`` and ``words`` of every turn.

    Turns are ordered by turn (null first), turns of one number by their digest. Null role or
    text is empty; rows with a null conv_id are left out. Rows are numbered range by range.
    """
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    rows = conversations.where(conversations["conv_id"].isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("no"),
    )
    rows = stored(rows, "turns")
    order = [F.col(c) for c in ("conv", "turn", "digest", "no")]
    return with_starts(rows, order, {"at": F.lit(1)}, ranges_for(rows)).select("conv", "at", "digest", "words")


def rebuilt(conversations: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv``, ``length``) and their turns (``conv``, ``depth`` from 1, ``digest``, ``words``).

    Conversation c gets the first h turns of conversation c - c % ``family`` (all if fewer, none if absent),
    then its own after the first h; h is the checksum of c modulo ``heads``.
    """
    turns = stored(numbered_turns(conversations), "numbered")
    lives = turns.groupBy("conv").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    lives = lives.withColumns({
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % heads,
        "base": F.col("conv") - F.col("conv") % family,
    })
    lives = stored(lives, "lives")
    bases = lives.where("conv = base").select("base", F.col("n").alias("base_n"))
    lives = lives.join(bases.hint("merge"), "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    lives = stored(lives.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "lives")
    placed = stored(turns.join(lives.hint("merge"), "conv").withColumn("place", F.col("at") - F.col("first")), "placed")
    own = placed.where("place >= h").select("conv", (F.col("k") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "words")
    given = placed.where(f"conv = base and place < {heads - 1}").select("base", "place", "digest", "words")
    front = lives.where("k > 0").select("conv", "base", "k").join(given, "base").where("place < k")
    front = front.select("conv", (F.col("place") + 1).alias("depth"), "digest", "words")
    return lives.select("conv", "length"), own.unionByName(front)


def segments(turns: DataFrame, lives: DataFrame) -> DataFrame:
    """``conv``, ``level``, ``length``, the ``seq`` of at most ``SEGMENT`` digests with their ``words``, ``g`` and ``deeper``.

    ``g`` stands for all turns before the segment (empty at level 0) and ``deeper`` for those up to its end, if the
    conversation goes on. Both come from sums of hashes, run over the ranges of all segments, so a very
    long conversation is many rows in many tasks.
    """
    turn = F.struct("depth", "digest", "words")
    cut = turns.groupBy("conv", F.floor((F.col("depth") - 1) / SEGMENT).alias("level")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    cut = cut.select(
        "conv", "level",
        F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), "")).alias("seq"), F.col("t.words").alias("words"),
    )
    cut = stored(cut.join(lives.hint("merge"), "conv"), "segments")
    short = cut.where(f"length <= {SEGMENT}").select("*", F.unhex(F.lit("")).alias("g"), F.lit(None).cast("binary").alias("deeper"))
    long = cut.where(f"length > {SEGMENT}")
    if long.isEmpty():
        return short
    lanes = "abcd"
    mark = F.md5(F.concat(F.col("level").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("seq")))
    parts = {x: F.conv(F.substring(mark, 8 * i + 1, 8), 16, 10).cast("bigint") for i, x in enumerate(lanes)}
    marked = stored(long.select("conv", "level", *[c.alias(f"own_{x}") for x, c in parts.items()]), "marks")
    sums = stored(with_starts(marked, [F.col("conv"), F.col("level")], {x: F.col(f"own_{x}") for x in lanes}, ranges_for(marked)), "sums")
    zero = sums.where("level = 0").select("conv", *[F.col(x).alias(f"zero_{x}") for x in lanes])
    before = [F.col(x) - F.col(f"zero_{x}") for x in lanes]
    name = lambda level, sums: F.unhex(F.md5(F.concat_ws(":", level, *sums)))
    keys = sums.join(zero, "conv").select(
        "conv", "level",
        F.when(F.col("level") == 0, F.unhex(F.lit(""))).otherwise(name(F.col("level"), before)).alias("g"),
        name(F.col("level") + 1, [b + F.col(f"own_{x}") for b, x in zip(before, lanes, strict=True)]).alias("deeper"),
    )
    goes_on = F.when(F.col("length") > (F.col("level") + 1) * SEGMENT, F.col("deeper"))
    return short.unionByName(long.join(keys, ["conv", "level"]).withColumn("deeper", goes_on))


def shared_turns(a: bytes, b: bytes) -> int:
    """How many digests two sequences have in common from their start."""
    most = min(len(a), len(b)) // WIDTH
    if a[: most * WIDTH] == b[: most * WIDTH]:
        return most
    low = 0  # the first low turns agree, the first most don't
    while most - low > 1:
        mid = (low + most) // 2
        low, most = (mid, most) if a[: mid * WIDTH] == b[: mid * WIDTH] else (low, mid)
    return low


def node_key(g: bytes, seq: bytes = b"") -> bytes:
    return hashlib.md5(b"node" + g + b":" + seq, usedforsecurity=False).digest()


class Tree:
    """A component of neighbouring classes: the node at ``depth`` that they share."""

    __slots__ = ("lo", "hi", "depth", "n", "conv", "children", "leaves", "saved", "cid", "deeper", "tops")

    def __init__(self, at: int, depth: int, n: int, conv: int, leaf: int, sub: tuple[int, int, int], cid, deeper) -> None:
        self.lo = self.hi = at
        self.depth, self.n, self.conv, self.cid, self.deeper = depth, n, conv, cid, deeper
        self.children, self.saved, self.leaves = sub[0], sub[2], leaf + sub[1]
        self.tops: list[dict] = []


def grown(rows: list[dict], left: int, right: int) -> list[dict]:
    """The nodes of a run of sorted classes; ``left`` and ``right`` are the turns shared with the classes around the run.

    Edges between neighbours are joined by union-find in descending depth; a merge is a node
    where branches meet, and the turns between it and the merge below are nodes with one child.
    Nodes shared with a class outside stay open: their numbers are sums over this run, in which a node
    counts where it appears first in sorted order. The root of each group is always open.
    """
    m, out = len(rows), []
    shared = [left]
    for a, b in zip(rows, rows[1:], strict=False):
        shared.append(shared_turns(a["seq"], b["seq"]) if a["g"] == b["g"] else 0)
    shared.append(right)
    up = list(range(m))
    trees: dict[int, Tree] = {}
    for i, r in enumerate(rows):
        size = len(r["seq"]) // WIDTH
        leaf = int(shared[i + 1] < size and r["deeper"] is None)
        trees[i] = Tree(i, size, r["cnt"], r["conv"], leaf, (r["sub_children"], r["sub_leaves"], r["sub_saved"]), r["cid"], r["deeper"])

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def first_here(t: Tree, depth: int) -> bool:
        return not (t.lo == 0 and depth <= left)

    def is_open(t: Tree, depth: int) -> bool:
        return (t.lo == 0 and depth <= left) or (t.hi == m - 1 and depth <= right)

    def raised(t: Tree, depth: int) -> None:
        """Write the nodes of a tree that lie deeper than ``depth``, which its top then hangs below."""
        r = rows[t.lo]
        start, tops = r["start"], t.tops
        for d in range(t.depth, depth, -1):
            t.saved += (t.n - first_here(t, d)) * r["words"][d - 1]
            opened = is_open(t, d)
            key = node_key(r["g"], r["seq"][: d * WIDTH]) if opened else None
            for x in tops:
                x["parent"], x["parent_key"] = (None, key) if opened else (t.conv, None)
            node = {
                "open": int(opened), "key": key, "depth": start + d, "conv": t.conv, "parent": None, "parent_key": None, "n": t.n,
                "children": t.children, "leaves": t.leaves, "saved": t.saved, "cid": t.cid, "deeper": t.deeper and node_key(t.deeper),
            }
            out.append(node)
            tops, t.children, t.cid, t.deeper = [node], int(first_here(t, d)), None, None
        t.depth, t.tops = depth, tops

    for d, i in sorted(((shared[i], i) for i in range(1, m) if shared[i]), reverse=True):
        a, b = find(i - 1), find(i)
        x, y = trees[a], trees.pop(b)
        raised(x, d)
        raised(y, d)
        up[b] = a
        x.hi, x.n, x.conv = y.hi, x.n + y.n, min(x.conv, y.conv)
        x.children, x.leaves, x.saved = x.children + y.children, x.leaves + y.leaves, x.saved + y.saved
        x.cid, x.deeper = x.cid or y.cid, x.deeper or y.deeper
        if len(x.tops) < len(y.tops):
            x.tops, y.tops = y.tops, x.tops
        x.tops.extend(y.tops)
    for t in trees.values():
        g, start = rows[t.lo]["g"], rows[t.lo]["start"]
        raised(t, 0)
        for x in t.tops:
            x["parent_key"] = node_key(g)
        out.append({
            "open": 2, "key": node_key(g), "depth": start, "conv": t.conv, "parent": None, "parent_key": None, "n": t.n,
            "children": t.children, "leaves": t.leaves, "saved": t.saved, "cid": None, "deeper": g,
        })
    return out


def _forest(arrow: pa.Schema, run_rows: int):
    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[dict] = []
        left, held = 0, 0

        def close(right: int) -> Iterator[pa.RecordBatch]:
            nodes = grown(run, left, right) if run else []
            for at in range(0, len(nodes), 10_000):
                yield pa.RecordBatch.from_pylist(nodes[at : at + 10_000], arrow)

        for batch in batches:
            for r in batch.to_pylist():
                if run and r["_block"] != run[-1]["_block"]:
                    yield from close(run[-1]["right"])
                    run, held, left = [], 0, r["left"]
                elif len(run) >= run_rows or held >= RUN_BYTES:
                    common = shared_turns(run[-1]["seq"], r["seq"]) if run[-1]["g"] == r["g"] else 0
                    yield from close(common)
                    run, held, left = [], 0, common
                elif not run:
                    left = r["left"]
                run.append(r)
                held += len(r["seq"]) * 3
        if run:
            yield from close(run[-1]["right"])

    return forest


def forest_nodes(classes: DataFrame) -> DataFrame:
    """Nodes of all classes as ``grown`` has them, range by range of the sorted order; what is open still has to be merged."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    sorted_ = classes.withColumn("start", F.col("level") * SEGMENT).repartitionByRange(ranges_for(classes), "g", "seq").withColumn("_block", F.spark_partition_id())
    sorted_ = stored(sorted_, "sorted")
    at = F.struct("g", "seq")
    ends = sorted_.groupBy("_block").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    order = Window.partitionBy(F.lit(0)).orderBy("_block")  # one row per range
    ends = ends.select("_block", "low", "high", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    common = (
        "coalesce(if({a}.g = {b}.g, aggregate(sequence(0L, least(length({a}.seq), length({b}.seq)) div 16), 0L, (n, i) -> if(i > 0 and n = i - 1 and "
        "substring({a}.seq, cast(16 * i - 15 as int), 16) = substring({b}.seq, cast(16 * i - 15 as int), 16), i, n)), 0L), 0L)"
    )
    around = ends.select("_block", *[F.expr(common.format(a=a, b=b)).cast("int").alias(n) for a, b, n in (("before", "low", "left"), ("high", "after", "right"))])
    rows = sorted_.join(around.hint("merge"), "_block").repartition("_block").sortWithinPartitions("_block", "g", "seq")
    kind = _parse_datatype_string(NODE)
    return rows.mapInArrow(_forest(to_arrow_schema(kind), RUN_ROWS), kind)


def merged(opened: DataFrame) -> DataFrame:
    """One row per open node: sums over the runs that hold it."""
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    firsts = [F.max(c).alias(c) for c in ("open", "depth", "parent_key", "cid", "deeper")]
    return opened.groupBy("key").agg(F.min("conv").alias("conv"), *sums, *firsts)


def with_deeper_levels(classes: DataFrame) -> DataFrame:
    """Add to each class what the trie below its end holds: ``sub_children``, ``sub_leaves`` and ``sub_saved``.

    Totals of a group run up to the groups above it by pointer doubling, so the passes grow with the logarithm of the levels.
    """
    none = {c: F.lit(0).cast("bigint") for c in ("sub_children", "sub_leaves", "sub_saved")}
    deep = classes.where("level > 0")
    if deep.isEmpty():
        return classes.withColumns(none)
    above = classes.where("level > 0 and deeper is not null").select(F.col("deeper").alias("group"), F.col("g").alias("over"))
    groups = merged(forest_nodes(deep.withColumns(none)).where("open = 2")).select(F.col("deeper").alias("group"), "children", "leaves", "saved")
    groups = stored(groups.join(above, "group", "left"), "groups")
    while not groups.where("over is not null").isEmpty():
        more = groups.where("over is not null").groupBy(F.col("over").alias("group")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        jump = groups.select(F.col("group").alias("over"), F.col("over").alias("next"))
        groups = groups.join(more, "group", "left").join(jump, "over", "left").select(
            "group", "children", F.expr("leaves + coalesce(l, 0)").alias("leaves"), F.expr("saved + coalesce(s, 0)").alias("saved"), F.col("next").alias("over")
        )
        groups = stored(groups, "groups")
    below = groups.select(F.col("group").alias("deeper"), *[F.col(c).alias(f"sub_{c}") for c in ("children", "leaves", "saved")])
    whole = classes.join(below, "deeper", "left")
    return whole.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in none})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each list from its pieces in order."""
    current, state = None, None
    for batch in batches:
        done = []
        for cid, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if cid != current:
                if state is not None:
                    done.append((current, state.hexdigest()))
                current, state = cid, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in ((0, pa.binary()), (1, pa.string()))], ["cid", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()])], ["cid", "sha"])


def hashed_lists(ends: DataFrame) -> DataFrame:
    """``cid`` and the hash of its ``conv`` numbers, ascending and joined by commas; a long list comes in pieces that many tasks write."""
    ranked = with_starts(ends, [F.col("cid"), F.col("conv")], {"at": F.lit(1)}, ranges_for(ends))
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = ranked.groupBy("cid", F.floor(F.col("at") / PIECE).alias("piece")).agg(piece.alias("ids"))
    ordered = pieces.repartition("cid").sortWithinPartitions("cid", "piece").select("cid", "ids")
    return ordered.mapInArrow(_hashed, "cid binary, sha string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations (see ``rebuilt``), the root first.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Turns are equal when role and text are. Equal
    segments are one class before anything is sorted, so a conversation that a third of all have is one row.
    Rows with a null conv_id are left out; turns that repeat a number are ordered by digest, so equal rows
    count as turns of their own. Extra columns are left out. An empty table has no trie, not even a root.
    """
    spark = conversations.sparkSession
    lives, turns = rebuilt(conversations)
    items = segments(turns, lives)
    cid = F.unhex(F.md5(F.concat(F.col("level").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("g"), F.col("seq"))))
    items = stored(items.withColumn("cid", cid), "items")
    classes = items.groupBy("level", "g", "seq", "cid").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("conv").alias("conv"), F.first("words").alias("words"), F.max("deeper").alias("deeper")
    )
    nodes = stored(forest_nodes(with_deeper_levels(stored(classes, "classes"))), "nodes")
    opened = stored(merged(nodes.where("open > 0")), "opened")

    everyone = lives.agg(F.min("conv"), F.count(F.lit(1))).first()
    top = opened.where("open = 2 and depth = 0").first()
    root_key = node_key(b"")
    if everyone[0] is None:
        root = _rows(spark, [])
    else:
        below = (top["children"], top["leaves"], top["saved"]) if top else (0, 1, 0)
        root = _rows(spark, [(everyone[0], 0, None, everyone[1], *below, ROOT_END)])
    named = opened.where("open = 1").select("key", F.col("conv").alias("named"))
    closed = nodes.where("open = 0")
    both = closed.select("conv", "depth", "parent", "parent_key", "n", "children", "leaves", "saved", "cid", "deeper").unionByName(
        opened.where("open = 1").select("conv", "depth", F.lit(None).cast("bigint").alias("parent"), "parent_key", "n", "children", "leaves", "saved", "cid", "deeper")
    )
    named = named.unionByName(both.where("deeper is not null").select(F.col("deeper").alias("key"), F.col("conv").alias("named")))
    is_top = F.col("parent_key") == F.lit(root_key)
    known = both.where(F.col("parent_key").isNull() | is_top).withColumn("parent", F.when(is_top, F.lit(everyone[0]).cast("bigint")).otherwise(F.col("parent")))
    asked = both.where(F.col("parent_key").isNotNull() & ~is_top).join(named.hint("merge"), F.col("parent_key") == F.col("key"))
    columns = ["conv", "depth", "parent", "n", "children", "leaves", "saved", "cid"]
    whole = known.select(*columns).unionByName(asked.withColumn("parent", F.col("named")).select(*columns)).unionByName(root)

    at_end = items.where(F.col("length") == F.col("level") * SEGMENT + F.size("words")).select("cid", "conv")
    ends = stored(at_end.unionByName(lives.where("length = 0").select(F.lit(ROOT_END).alias("cid"), "conv")), "ends")
    whole = whole.join(hashed_lists(ends).hint("merge"), "cid", "left")
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "conv bigint, depth bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, cid binary")


ORACLE = r"""
WITH turns AS (
    SELECT conv_id AS c, md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
        len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w, turn
    FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
    SELECT c, list({'d': d, 'w': w} ORDER BY turn NULLS FIRST, d) AS t,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
            lambda s, b: list_reduce(list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda v, z: xor(v // 2, 3988292384 * (v % 2))))) % 4 AS h
    FROM turns GROUP BY c
), built AS (
    SELECT a.c, list_concat(coalesce(list_slice(b.t, 1, a.h), []), list_slice(a.t, a.h + 1, len(a.t))) AS t
    FROM lists a LEFT JOIN lists b ON b.c = a.c - a.c % 20
), prefixes AS (
    SELECT c, len(t) AS size, unnest(list_transform(range(0, len(t) + 1), lambda i: {'i': i,
        'k': list_transform(list_slice(t, 1, i), lambda x: x.d)::VARCHAR, 'p': CASE WHEN i > 0 THEN list_transform(list_slice(t, 1, i - 1), lambda x: x.d)::VARCHAR END,
        'w': CASE WHEN i > 0 THEN t[i].w ELSE 0 END})) AS x
    FROM built
), nodes AS (
    SELECT x.k AS k, x.i AS depth, any_value(x.p) AS p, min(c) AS conv_id, count(*) AS n, any_value(x.w) AS w,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = x.i), '')) AS ends_sha256
    FROM prefixes GROUP BY x.k, x.i
), children AS (
    SELECT p AS k, count(*) AS n_children FROM nodes WHERE p IS NOT NULL GROUP BY p
), full_nodes AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (k)
), sums AS (
    SELECT x.k AS k, sum((v.n - 1) * v.w)::BIGINT AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
    FROM full_nodes v JOIN prefixes ON c = v.conv_id AND x.i <= v.depth GROUP BY x.k
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM full_nodes v JOIN sums USING (k) LEFT JOIN full_nodes u ON u.k = v.p
"""


@query("op12_prefix_trie", ORACLE)
def op12_prefix_trie(spark, folder):
    return conversation_trie(table(spark, folder, "conversations"))
