from __future__ import annotations

import random
import zlib

import numpy as np

from tallyhouse.llm.toxicity import features, fit_ngrams, op7_toxicity, score_toxicity, train_toxicity

SCHEMA = "doc_id bigint, text string, score string, _y int"


def brute_features(text):
    text = f" {text.lower()} "
    return len({text[i : i + n] for n in (3, 4, 5, 6) for i in range(len(text) - n + 1)})


def test_features_are_the_distinct_ngrams():
    draw = random.Random(1)
    for size in (0, 1, 2, 5, 60):
        text = "".join(draw.choice("abcé X") for _ in range(size))
        assert brute_features(text) - 2 <= len(features(text)) <= brute_features(text)  # buckets may clash
    # n-grams that lie across the pieces of a long text are seen too
    inner = set(features("x" * 65_530 + "unseen" + "x" * 70_000))
    assert inner >= set(features("xxxxxxunseenxxxxxx")) and inner - set(features("x" * 140_000))


def test_learns(spark):
    draw = random.Random(2)
    words = ["lake", "tree", "stone", "river", "cloud"]
    rows, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        text = [draw.choice(words) for _ in range(draw.randint(3, 60))]
        if toxic:
            text.insert(draw.randrange(len(text)), "vilest")
        rows.append((i, " ".join(text), "x", 1))
        labels.append((i, int(toxic)))
    extra = [(900, None, "x", 1), (901, "", "x", 1), (902, "river " * 40_000 + "vilest", "x", 1), (None, "lake", "x", 1)]
    docs = spark.createDataFrame([*rows, *extra], SCHEMA)
    marks = spark.createDataFrame([*labels, (900, None), (12345, 1), (901, 7)], "doc_id bigint, toxic int")
    model = train_toxicity(docs, marks)
    out = score_toxicity(docs, model)
    assert out.columns == ["doc_id", "text", "_y", "score", "predicted"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 304 and got[900].score == got[901].score
    assert all(got[i].predicted == y for i, y in labels) and got[902].predicted == 1 and got[None].predicted == 0
    assert score_toxicity(docs.limit(0), model).count() == 0


def test_one_class_gives_the_prior():
    model = fit_ngrams([0, 0], [features("a"), features("b")], prior=0.2)
    assert abs(model.score("anything") - 0.2) < 1e-9 and np.all(model.weights == 0)


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op7_toxicity(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = sorted((r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels)
    ranks = [i for i, (_, y) in enumerate(tested) if y]
    auc = (sum(ranks) - len(ranks) * (len(ranks) - 1) / 2) / len(ranks) / (len(tested) - len(ranks))
    assert auc > 0.85  # some labels of this small table are flipped
