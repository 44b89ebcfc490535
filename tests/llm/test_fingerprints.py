from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tallyhouse.config import watched_tables
from tallyhouse.llm import fingerprints
from tallyhouse.llm.fingerprints import LONG_LINE, fingerprint, op4_fingerprints, paragraph_changes, paragraph_digests


def paragraphs(text):
    parts = [p for x in re.split(r"\n+", text or "") for p in (re.split(r"(?<=[.!?])\s+", x) if len(x) > LONG_LINE else [x])]
    return {p for p in parts if p.strip(" ")}


def test_changes_are_recovered(spark):
    draw = random.Random(3)
    rows = []
    for i, (both, a, b) in enumerate([(0, 0, 0), (5, 0, 0), (5, 3, 2), (0, 9, 9), (50, 20, 0), (10, 300, 250), (2000, 1, 0), (0, 1, 0)]):
        common = {draw.getrandbits(63) for _ in range(both)}
        rows.append((i, [*common, *(draw.getrandbits(63) - 2**62 for _ in range(a))], [*common, *(-draw.getrandbits(62) for _ in range(b))], "x"))
    rows.append((8, None, [1, 2], "x"))
    pairs = spark.createDataFrame(rows, "id int, a array<bigint>, b array<bigint>, _no string")
    out = paragraph_changes(pairs, "a", "b")
    assert out.columns == ["id", "a", "b", "_no", "only_left", "only_right"]
    for r in out.collect():
        a, b = set(r.a or []), set(r.b or [])
        assert (set(r.only_left), set(r.only_right)) == (a - b, b - a), r.id
    assert out.count() == len(rows)
    assert paragraph_changes(pairs.limit(0), "a", "b").count() == 0


def test_fingerprint_edges(spark):
    texts = [None, "", " \n\n ", "one\ntwo", "one\n\ntwo", "two\none", "x. " * 100_000, "one\ntwo\nthree"]
    rows = fingerprint(spark.createDataFrame([(t, "clash") for t in texts], "text string, fingerprint string")).collect()
    prints = [r.fingerprint for r in rows]
    assert len(set(prints[:3])) == 1 and len(set(prints[3:6])) == 1 and len(set(prints)) == 4
    assert all(len(p) == 36 * 28 for p in prints)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    texts = {r.doc_id: r.text for r in docs}
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in op4_fingerprints(spark, folder).collect()}
    assert sorted(rows) == sorted(texts)
    prints = {}
    for doc, following in zip(order, [*order[1:], order[0]], strict=True):
        text, r = texts[doc], rows[doc]
        k = len(text) // 3
        edited = text[: len(text) - k] + texts[following][:k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, r.near_edited), (texts[following], r.near_next)):
            a, b = paragraphs(text), paragraphs(other)
            want = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - want) < 1e-12
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint


def test_short_lines_are_cut_at_sentences(spark):
    short = "One is here. Two is there! Is three anywhere? Four is left. Five goes. Six stays."
    line = " ".join(f"Sentence number {i} of a longer line." for i in range(13))
    texts = [(short, short[:55] + "Something else. Ends."), (line, line + " This end is a new one. And so is this one.")]
    assert len(line) < 512 < len(texts[1][1])
    rows = spark.createDataFrame(texts, "a string, b string").select(
        paragraph_digests(F.col("a")).alias("a"), paragraph_digests(F.col("b")).alias("b")
    ).collect()
    assert [(len(r.a), len(set(r.a) & set(r.b))) for r in rows] == [(6, 3), (13, 13)]


def test_null_and_repeated_ids(spark, tmp_path):
    texts = ["One is here. Two is there. Three goes.", "Four is left. Five goes on. Six ends."]
    rows = [(5, texts[0]), (5, texts[0]), (5, texts[1]), (None, texts[1]), (None, None), (2, ""), (1, texts[0])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op4_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert sorted(r.n_chars for r in got) == sorted(len(r[1] or "") for r in rows)
    by_text = {}
    for r in got:
        by_text.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert all(len(x) == 1 for n, x in by_text.items() if n != len(texts[1]) or len(texts[0]) != len(texts[1]))
    twice = [r for r in got if r.doc_id == 5 and r.n_chars == len(texts[0])]
    assert len({tuple(r) for r in twice}) in (1, 2)


def test_estimates_only_steer_the_first_size(spark, monkeypatch):
    """A sketch that is far too small is made again, larger, until everything is found."""
    monkeypatch.setattr(fingerprints, "ROOM", 0.0)
    monkeypatch.setattr(fingerprints, "SPARE", 2)
    pairs = spark.createDataFrame([(1, list(range(100)), list(range(90, 300)))], "id int, a array<bigint>, b array<bigint>")
    row = paragraph_changes(pairs, "a", "b").first()
    assert row.only_left == list(range(90)) and row.only_right == list(range(100, 300))


def test_few_jobs_whatever_the_rounds(spark, monkeypatch):
    """Sketches are peeled in their rows, so tables and jobs grow neither with the rounds of peeling nor with the rows."""
    monkeypatch.setattr(fingerprints, "PIECE", 64, raising=False)
    draw = random.Random(5)
    both = [draw.getrandbits(63) for _ in range(300)]
    rows = [(i, [*both[:i], *(draw.getrandbits(62) for _ in range(i))], [*both[: 2 * i], -i]) for i in range(150)]
    pairs = spark.createDataFrame(rows, "id int, a array<bigint>, b array<bigint>").repartition(4)
    with watched_tables() as made:
        out = paragraph_changes(pairs, "a", "b")
    assert len(made) <= 12
    for r in out.collect():
        assert (set(r.only_left), set(r.only_right)) == (set(r.a) - set(r.b), set(r.b) - set(r.a)), r.id
