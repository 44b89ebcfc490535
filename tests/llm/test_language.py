from __future__ import annotations

import random

from tallyhouse.llm.language import WINDOW, identify, keep_identified, op6_language_id, predictions, train_language, windows_of

SCHEMA = "doc_id bigint, text string, lang string, score string, _row int"
ALPHABETS = {"ab": "abcde ", "xy": "vwxyzé "}


def corpus(number=240):
    draw = random.Random(4)
    rows = []
    for i in range(number):
        lang = draw.choice(sorted(ALPHABETS))
        rows.append((i, "".join(draw.choice(ALPHABETS[lang]) for _ in range(draw.randint(5, 900))), lang, "x", 1))
    return rows


def test_windows_cover_every_byte():
    for size in (1, WINDOW - 1, WINDOW, WINDOW + 1, 5 * WINDOW):
        data = bytes(1 + i % 250 for i in range(size))
        assert windows_of(data).tobytes().rstrip(b"\0") == data


def test_learns_and_handles_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    net = train_language(docs)
    odd = [(1001, None, None, "x", 1), (1002, "", "ab", "x", 1), (1003, "12 3!", "ab", "x", 1), (1004, "b" * 300_000, None, "x", 1), (None, "abcd abcd abcd", "ab", "x", 1)]
    out = identify(spark.createDataFrame([*rows, *odd], SCHEMA), net)
    assert out.columns == ["doc_id", "text", "lang", "_row", "lang_pred", "score"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) + 5
    assert sum(got[r[0]].lang_pred == r[2] for r in rows) / len(rows) > 0.98
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1001, 1002, 1003))
    assert got[1004].lang_pred == "ab" and got[None].lang_pred == "ab"
    assert all(0 <= r.score <= 1 for r in got.values())
    texts = [r[1] for r in rows[:40]]
    alone = [dict(predictions(net, [t])).get(0) for t in texts]
    together = dict(predictions(net, texts))
    assert all(abs(together[i] - p).max() < 1e-5 for i, p in enumerate(alone) if p is not None)


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "abc", None, None, None)], SCHEMA)
    assert train_language(docs) is None
    assert [r.lang_pred for r in identify(docs, None).collect()] == ["und"]
    assert identify(docs.limit(0), None).count() == 0


def test_filter_keeps_columns(spark):
    docs = spark.createDataFrame([*corpus(), (9001, None, None, "x", 1), (9002, "...", None, "x", 1)], SCHEMA)
    out = keep_identified(docs)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert len(kept) >= 235 and not kept & {9001, 9002}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text").collect()}
    rows = op6_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    tested = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in tested) / len(tested) > 0.93
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in truth[r.doc_id].text or "")) for r in rows)
