"""Shards of near equal size: minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.config import stored
from tallyhouse.llm.common import ranges_for, with_starts
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

# Pieces of the ordered groups that the driver holds per pass.
COARSE = 2048
FINE = 64


def shard_rows(
    rows: DataFrame, id_col: str, size_col: str, group_col: str, shards: int, parts: int | None = None
) -> DataFrame:
    """Add ``shard`` and ``slot``: contiguous runs of whole groups, the largest run as small as can be.

    Groups (equal values of ``group_col``; null is a group of its own) are ordered by their
    smallest id, null ids first, then by the group value; rows inside a group by id.
    The smallest feasible capacity is found by binary search, each guess checked greedily;
    the cuts are those of the greedy pass at that capacity. A group is never cut, so one
    larger than the rest of its shard decides the capacity. There may be fewer runs than
    ``shards``; then the last ones are empty. Negative or null sizes count as 0.

    ``slot`` counts the rows of a shard from 0 without gaps. Rows that agree in id and
    group may swap slots. Extra columns stay as they are; ``shard`` and ``slot`` replace
    columns of the same name. An empty table gives an empty table.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    parts = parts or ranges_for(rows)
    fixed = stored(
        rows.select(
            *[rows[c].alias(f"_c{i}") for i, c in enumerate(names)],
            rows[id_col].alias("_id"),
            rows[group_col].alias("_group"),
            F.greatest(F.coalesce(rows[size_col].cast("bigint"), F.lit(0)), F.lit(0)).alias("_size"),
            F.monotonically_increasing_id().alias("_no"),
        ),
        "rows",
    )
    groups = fixed.groupBy("_group").agg(
        F.min("_id").alias("_first"), F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    order = [F.col("_first"), F.col("_group")]
    placed = stored(with_starts(stored(groups, "groups"), order, {"_at": F.col("_bytes"), "_row": F.col("_rows")}, parts), "placed")
    cuts = minimax_cuts(placed, shards)
    shard = sum((F.when(F.col("_at") >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    firsts = placed.select(F.col("_group").alias("_same"), "_row", shard.alias("shard"))
    starts = firsts.groupBy("shard").agg(F.min("_row").alias("_start"))
    members = fixed.join(firsts, F.col("_group").eqNullSafe(F.col("_same")))
    members = members.join(F.broadcast(starts), "shard")  # one row per shard
    numbered = with_starts(
        members, [F.col("_row"), F.col("_id"), F.col("_no")], {"_place": F.lit(1)}, parts
    )
    return numbered.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)], "shard", (F.col("_place") - F.col("_start")).alias("slot")
    )


def minimax_cuts(placed: DataFrame, shards: int) -> list[int]:
    """Offsets at which shards 1, 2 ... start, from groups with ``_at`` (bytes before) and ``_bytes``.

    The driver never sees all groups. It holds pieces: runs of whole groups that start in
    the same stretch of bytes. Cutting at piece borders only gives a capacity that is at
    most the largest piece too large; that leaves narrow windows in which the true cuts
    lie. Pieces in a window are read again in finer stretches until each holds one group;
    then the greedy pass over the pieces is the pass over the groups. The number of pieces
    depends on the number of shards, not of rows; the number of passes on the logarithm of
    the total.
    """
    total, largest = placed.agg(
        F.coalesce(F.max(F.col("_at") + F.col("_bytes")), F.lit(0)), F.coalesce(F.max("_bytes"), F.lit(0))
    ).first()
    if total == 0:
        return []
    step = max(1, math.ceil(total / COARSE))
    pieces = _pieces(placed.where("_bytes > 0"), step)
    while True:
        low, high = max(largest, math.ceil(total / shards)), _smallest(pieces, shards)
        floor, ceiling = _reach(pieces, low, shards, False), _reach(pieces, high, shards, True)
        wide = [
            p for p in pieces
            if p[2] > 1 and any(a <= p[0] + p[1] and p[0] <= b for a, b in zip(floor, ceiling, strict=True))
        ]
        if not wide or step == 1:
            break
        step = max(1, math.ceil(step / FINE))
        chosen = _any_between([(p[0], p[0] + p[1]) for p in wide])
        finer = _pieces(placed.where("_bytes > 0").where(chosen), step)
        pieces = sorted([p for p in pieces if p not in set(wide)] + finer)
    return _greedy(pieces, _smallest(pieces, shards))


def _any_between(spans: Sequence[tuple[int, int]]):
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    tests = [(F.col("_at") >= a) & (F.col("_at") < b) for a, b in merged]
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


def _pieces(groups: DataFrame, step: int) -> list[tuple[int, int, int]]:
    """(start, bytes, groups) of the runs that start in the same stretch of ``step`` bytes."""
    runs = groups.groupBy(F.floor(F.col("_at") / F.lit(step)).alias("_stretch")).agg(
        F.min("_at").alias("a"), F.sum("_bytes").alias("b"), F.count(F.lit(1)).alias("n")
    )
    return sorted((r.a, r.b, r.n) for r in runs.collect())


def _greedy(pieces: Sequence[tuple[int, int, int]], capacity: int) -> list[int]:
    """Starts of the runs after the first, each filled as far as the capacity allows."""
    ends = [a + b for a, b, _ in pieces]
    cuts, start, i = [], 0, 0
    while True:
        i = bisect_right(ends, start + capacity, i)
        if i == len(pieces):
            return cuts
        start = pieces[i][0]
        cuts.append(start)


def _smallest(pieces: Sequence[tuple[int, int, int]], shards: int) -> int:
    """The smallest capacity with which the pieces fill at most ``shards`` runs."""
    total = sum(p[1] for p in pieces)
    low, high = max(max(p[1] for p in pieces), math.ceil(total / shards)), total
    while low < high:
        middle = (low + high) // 2
        if len(_greedy(pieces, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def _reach(pieces: Sequence[tuple[int, int, int]], capacity: int, shards: int, up: bool) -> list[int]:
    """A bound for each cut of the greedy pass over the groups: at least this, or with ``up`` at most this."""
    starts = [p[0] for p in pieces]
    end, bounds, at = pieces[-1][0] + pieces[-1][1], [], 0
    for _ in range(shards - 1):
        at = min(at + capacity, end)
        i = bisect_right(starts, at) - 1
        at = pieces[i][0] + pieces[i][1] if up else pieces[i][0]
        bounds.append(at)
    return bounds


@query("op9_sharding")
def op9_sharding(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("same"),
    )
    return shard_rows(rows, "doc_id", "size", "same", 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
