from __future__ import annotations

import math

import numpy as np
import pytest

from tallyhouse.llm import hard_negatives
from tallyhouse.llm.hard_negatives import Block, fit, mine_negatives, packed, unpacked

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, block int"


def brute(rows, every=50):
    kept = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i, label, tuple(math.floor(256 * x) for x in v)] = 1
    kept, out = sorted(kept), set()
    for me, label, q in [k for k in kept if k[0] % every == 0]:
        if (me, label, q) != min(k for k in kept if k[0] == me):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, v)), i, other) for i, other, v in kept if i != me))  # noqa: B905
        for s, i, _ in [x for x in scored if x[2] == label][:5]:
            negatives = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out |= {(me, i, r, x[1], -s, -x[0]) for r, x in enumerate(negatives, 1)}
    return out


def clustered(n, dims=6, seed=1):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(12, dims))
    v = centers[draw.integers(0, 12, n)] + 0.15 * draw.normal(size=(n, dims))
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(int(i), [float(x) for x in v[i]], int(draw.integers(0, 4)), "clash", 7) for i in range(n)]
    # a third of all rows have the same vector, and ties are many
    return [(i, rows[0][1] if i % 3 == 0 else x, label, *rest) for i, x, label, *rest in rows]


@pytest.mark.parametrize(("block", "group"), [(8192, 4096), (20, 3)])
def test_equals_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", group)
    rows = clustered(500, seed=block)
    got = [tuple(r) for r in mine_negatives(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()]
    want = brute(rows)
    assert len(got) == len(want) > 50 and set(got) == want


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, i / 100], i % 2, None, None) for i in range(20)]
    rows += [(50, [1.0, 0.5], 0, None, None), (50, [1.0, 0.5], 0, None, None), (100, [1.0], 0, None, None), (150, [], 1, None, None), (200, [-1.0, 0.0], 0, None, None)]
    rows += [(250, None, 1, None, None), (300, [1.0, None], 1, None, None), (350, [nan, 1.0], 1, None, None), (400, [inf, 1.0], 1, None, None)]
    rows += [(450, [1.0, 1.0], None, None, None), (None, [1.0, 1.0], 1, None, None), (21, [0.5, 0.5, 9.0], 1, None, None), (-50, [0.9, 0.1], 1, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in mine_negatives(frame).collect()} == brute(rows)
    assert mine_negatives(frame.limit(0)).count() == 0
    big = [(i, [1e6 * (i + 1), 1.0], i % 2, None, None) for i in range(4)]
    assert {tuple(r) for r in mine_negatives(spark.createDataFrame(big, SCHEMA), every=2).collect()} == brute(big, 2)


def test_search_stops_at_certified_windows():
    rows = clustered(3000, seed=5)
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    books = fit(v[:500].astype(float), 16)
    codes = books.assign(v.astype(float))
    block = Block(books, list(zip([r[0] for r in rows], [r[2] for r in rows], packed(v), *codes, strict=True)))
    seen, scores = [], block.scores
    block.scores = lambda q, spans: (seen.append(sum(e - s for s, e in spans)), scores(q, spans))[1]
    for me in (0, 50, 100, 1501):
        high, low = block.cells.bounds(v[me : me + 1].astype(float))
        best = block.positives(me, rows[me][2], v[me].astype(float), [h[0] for h in high], [x[0] for x in low], -(2**62))
        want = sorted((-int(v[i] @ v[me]), i) for i in range(len(rows)) if i != me and rows[i][2] == rows[me][2])[:5]
        assert best == [(-s, i) for s, i in want]
    # recall is 1 by proof; the bounds leave out most rows of clustered vectors
    assert sum(seen) < 4 * len(rows) * 0.7


def test_packing():
    m = np.array([[1, -2, 3], [300, 4, 5], [2**40, 0, -1]], np.int64)
    for i in range(3):
        assert np.array_equal(unpacked(packed(m[i : i + 1]), 3), m[i : i + 1])
    assert np.array_equal(unpacked([*packed(m[:1]), *packed(m[1:])], 3), m)
