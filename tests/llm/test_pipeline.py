"""Each stage against brute force on its own input."""

from __future__ import annotations

import duckdb

import corpus_pipeline
from tallyhouse.config import stored
from tallyhouse.plans.registry import ORACLES
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import check_packed

FOLDER = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], FOLDER), name))
    assert all(s.columns == columns for s in steps[:-1])
    raw, spoken, single, distinct, mixed, packed = [s.collect() for s in steps]

    lettered = {r.doc_id for r in raw if any(c.isalpha() for c in r.text or "")}
    kept = {r.doc_id for r in spoken}
    assert kept <= lettered and len(kept) >= 0.98 * len(lettered)

    largest = {}
    for r in spoken:
        key = r.text.translate(LOWER)
        largest[key] = max(largest.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(largest.values())

    linked = brute([(r.doc_id, r.text) for r in single], 5, 80)
    assert sorted(r.doc_id for r in distinct) == sorted(d for d, (_, root) in linked.items() if d == root)

    con = duckdb.connect()
    con.register("documents", steps[3].toPandas())
    want = {d: n for d, n in con.execute(f"SELECT doc_id, copies FROM ({ORACLES['op5_mixing']})").fetchall() if n}
    got = {}
    for r in mixed:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want

    check_packed(packed, 2048)
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(r.doc_id for r in mixed)


def test_runs_on_empty_table(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
