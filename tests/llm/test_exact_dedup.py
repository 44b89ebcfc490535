from __future__ import annotations

from tallyhouse.llm.exact_dedup import drop_copies, mark_copies

SCHEMA = "doc_id bigint, text string, keep_id string, _c0 int"


def expected(rows):
    """Brute force: the kept row of each text, by lower-cased A-Z."""
    lower = {c: c + 32 for c in range(65, 91)}
    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").translate(lower), []).append(r[0])
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_edges(spark):
    long = "x" * 70_000
    rows = [
        (1, "Same Text"), (5, "same text"), (3, "SAME TEXT"), (4, "other"), (6, None), (7, ""), (8, None),
        (9, long), (10, long.upper()), (11, long + "y"), (12, "x" * 64), (13, "x" * 1024), (14, "x" * 1024),
        (15, "x" * 1025), (16, "É"), (17, "é"), (None, "nameless"), (None, "nameless"), (20, "twice"), (20, "twice"),
        (21, "x" * 16384), (22, "x" * 16385),
    ]
    marked = mark_copies(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA))
    got = marked.collect()
    want = expected(rows)
    lower = {c: c + 32 for c in range(65, 91)}
    assert marked.columns == ["doc_id", "text", "_c0", "keep_id", "group_size", "kept"]
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[(r.text or "").translate(lower)]
    kept = [(r.text or "").translate(lower) for r in got if r.kept]
    assert sorted(kept) == sorted(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x", 1), (2, "A", "y", 2), (3, "b", None, None)], SCHEMA)
    out = drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == [(2, "A", "y", 2), (3, "b", None, None)]


def test_empty(spark):
    assert mark_copies(spark.createDataFrame([], SCHEMA)).count() == 0
