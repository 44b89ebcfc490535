from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from tallyhouse.llm import sharding
from tallyhouse.llm.sharding import op9_sharding, shard_rows

SCHEMA = "id bigint, size bigint, same string, _group int, shard string"


def smallest(sizes, shards):
    """Brute force: the smallest largest run of any contiguous partition."""
    best = [[0] * (shards + 1) for _ in range(len(sizes) + 1)]
    for n in range(1, len(sizes) + 1):
        for k in range(1, shards + 1):
            if k == 1:
                best[n][k] = sum(sizes[:n])
                continue
            best[n][k] = min(max(best[m][k - 1], sum(sizes[m:n])) for m in range(n + 1))
    return best[len(sizes)][shards]


@pytest.mark.parametrize("seed", [0, 1])
def test_smallest_capacity(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "COARSE", 8)
    monkeypatch.setattr(sharding, "FINE", 3)
    draw = random.Random(seed)
    rows = [(i, draw.randrange(1, 200), f"g{draw.randrange(60)}", 0, "x") for i in range(120)]
    rows += [(200 + i, 3, None, 0, "x") for i in range(5)]
    shards = 5
    out = shard_rows(spark.createDataFrame(rows, SCHEMA), "id", "size", "same", shards).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    ordered = sorted(groups.values(), key=lambda g: min(r[0] for r in g))
    want = smallest([sum(r[1] for r in g) for g in ordered], shards)
    filled = Counter()
    for r in out:
        filled[r.shard] += r.size
    assert len(out) == len(rows) and max(filled.values()) == want
    assert len({(r.same, r.shard) for r in out}) == len(groups)
    for s in filled:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    shard_of = {r.id: r.shard for r in out}
    runs = [shard_of[g[0][0]] for g in ordered]
    assert runs == sorted(runs)


def test_edges(spark):
    assert shard_rows(spark.createDataFrame([], SCHEMA), "id", "size", "same", 4).count() == 0
    rows = [(None, None, None, 1, "a"), (None, -5, "b", 1, "a"), (1, 7, "b", 1, "a"), (1, 7, "b", 1, "a")]
    out = shard_rows(spark.createDataFrame(rows, SCHEMA), "id", "size", "same", 4)
    assert out.columns == ["id", "size", "same", "_group", "shard", "slot"]
    assert len({r.shard for r in out.collect() if r.same == "b"}) == 1 and out.count() == 4


def test_query(spark):
    rows = op9_sharding(spark, "/root/testdata/sf0.001").collect()
    sizes, counts = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        counts[r.shard].append(r.slot)
    assert set(sizes) == set(range(16))
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    homes = defaultdict(set)
    for r in rows:
        homes[texts[r.doc_id] or ""].add(r.shard)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 1 and r.law == "bytes" and r.grown_shard is None
    assert all(len(h) == 1 for h in homes.values()) and len(rows) == len(texts)
