from __future__ import annotations

import math
from collections import defaultdict

import duckdb
import pytest

from tallyhouse.llm.mixing import mix_sources, mixing_plan, op5_mixing, tempered_exponent
from tallyhouse.plans.registry import ORACLES

SCHEMA = "doc_id bigint, text string, source string, place int, _draw string"


def corpus():
    rows, doc = [], 0
    for source, number, words in (("big", 300, 40), ("mid", 60, 20), ("few", 5, 7), (None, 4, 3)):
        for i in range(number):
            doc += 1
            rows.append((doc, " ".join(["w"] * (words + i % 5)), source, 1, "x"))
    return [*rows, (9001, None, "big", 1, "x"), (9002, "  ", "mid", 1, "x"), (9003, None, "void", 1, "x"), (None, "a b", "few", 1, "x")]


def test_exponent(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 0)], "source string, tokens bigint")
    shares = [1000 / 1110, 100 / 1110, 10 / 1110]

    def entropy(a):
        w = [s**a for s in shares]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    a = tempered_exponent(totals, evenness=0.8, repeats=1e9)
    assert abs(entropy(a) - 0.8 * math.log(3)) < 1e-4
    b = tempered_exponent(totals, evenness=1.0, repeats=5.0)
    w = [s**b for s in shares]
    assert abs(w[2] / sum(w) / shares[2] - 5.0) < 1e-3
    assert tempered_exponent(totals.where("tokens = 0")) is None
    assert tempered_exponent(totals.where("source = 'a'")) == 1.0


def test_plan_against_sql(spark, tmp_path):
    docs = spark.createDataFrame([r for r in corpus() if r[0] is not None], SCHEMA)
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = op5_mixing(spark, str(tmp_path)).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(ORACLES["op5_mixing"]).df().sort_values("doc_id").reset_index(drop=True)
    for c in want.columns:
        assert [None if v is None else str(v) for v in got[c]] == [None if v is None else str(v) for v in want[c]], c
    assert (got.repeat_ppm[got.source == "few"] > 1_000_000).all()


@pytest.mark.parametrize("block", [50, 100_000])
def test_budgets_hold_in_blocks(spark, block):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    rows = mixing_plan(docs, block_tokens=block).collect()
    assert len(rows) == len(corpus())
    blocks = defaultdict(list)
    for r in rows:
        blocks[(r.source, r.block)].append(r)
    for members in blocks.values():
        assert sorted(r.place for r in members) == list(range(len(members)))
        longest = max(r.n_tokens for r in members)
        wanted = sum(r.n_tokens for r in members) * members[0].repeat_ppm / 1e6
        assert abs(sum(r.copies * r.n_tokens for r in members) - wanted) <= longest
    out = mix_sources(docs, block_tokens=block)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix_sources(docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a", 1, "x"), (2, "", None, 1, "x")], SCHEMA)
    assert mix_sources(blank).count() == 2
