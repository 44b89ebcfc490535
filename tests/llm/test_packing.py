from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import packing
from tallyhouse.llm.packing import Encoder, default_tokenizer, op8_best_fit_packing, pack, plan_bins, token_pieces

ODD = [
    "", "a'S it's I'LL ''s !'s", "<|ENDOFTEXT|> x <|endoftext|>y", "ΣΑΣ όδος İstanbul ǅ Ⅷ ² ½ ªº µ ÿÝ",
    "a\x1cb c\x85d e f", "été É", "日本語 テスト。", "😀a1b22", "x" * 5000, "‘quote’ K Å",
]


def check_packed(rows, capacity):
    """Gapless sequences within the capacity; returns their number."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        items.sort()
        assert items[0][0] == 0 and sum(n for _, n in items) <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(items, items[1:], strict=False))
    assert set(bins) == set(range(len(bins)))
    return len(bins)


def test_ids_are_the_tokenizers(spark):
    encoder = Encoder.at(default_tokenizer())
    docs = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*ODD, *docs]:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_any_vocabulary_and_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 40)
    monkeypatch.setattr(packing, "STRETCH", 50)
    draw = random.Random(3)
    made = [" ".join(draw.choice(["It's", "a1b", "Éa-x,", "日本", "x" * 90, f"n{draw.randint(0, 99)}"]) for _ in range(60)) for _ in range(20)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = Encoder(default_tokenizer().replace("word_bpe_49k.json", name))
        assert encoder.by_word == name.startswith("word")
        for text in [*ODD, "Hello World, this is A Test", *made]:
            want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
        assert len(encoder.known.new) + len(encoder.known.old) <= 2 * (40 // 2 + 60)
        assert all(len(w) <= 64 for w in encoder.known.new)


@pytest.mark.parametrize("seed", range(40))
def test_plan(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 30, 100])
    lengths = Counter(draw.randint(1, capacity) for _ in range(draw.randint(0, 300)))
    plan = plan_bins(lengths, capacity)
    placed = Counter()
    for number, items in plan:
        assert number > 0 and 0 < sum(n * c for n, c in items) <= capacity
        assert sum(c for n, c in items if 3 * n > capacity) <= 2
        for n, c in items:
            placed[n] += number * c
    assert placed == lengths
    large = sorted((n for n in lengths.elements() if 3 * n > capacity), reverse=True)
    bins = sum(number for number, _ in plan)
    least = -(-sum(n * c for n, c in lengths.items()) // capacity)
    pairs = sum(number for number, items in plan if sum(c for n, c in items if 3 * n > capacity) == 2)
    assert len(large) - pairs <= bins <= max(least * 1.25 + 2, len(large) - pairs)


def test_pack_and_pieces(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", "x"), (4, "word " * 45, None), (4, "word " * 45, None), (6, "é" * 9, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, piece string")
    pieces = token_pieces(docs, capacity=10, with_ids=True)
    got = pieces.collect()
    tokenizer = Tokenizer.from_file(default_tokenizer())
    ids = defaultdict(list)
    for r in sorted(got, key=lambda r: r.piece):
        assert r.start == 10 * r.piece and r.length == len(r.ids) <= 10
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        ids[r.doc_id] += r.ids
    assert ids[1] == ids[2] == [0]
    assert ids[6] == [*tokenizer.encode("é" * 9, add_special_tokens=False).ids, 0]
    assert len(ids[4]) == 2 * 46 and len([r for r in got if r.doc_id == 4]) == 10
    check_packed(pack(pieces.drop("ids"), capacity=10, parts=3).collect(), 10)
    assert pack(token_pieces(docs.limit(0))).count() == 0


def test_query(spark):
    rows = op8_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    used = check_packed(rows, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.05 + 1
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(default_tokenizer())
    pieces = {(r.doc_id, r.piece): r for r in rows}
    assert len(pieces) == len(rows)
    for doc, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece in range(-(-len(ids) // 2048)):
            part, r = ids[2048 * piece : 2048 * piece + 2048], pieces.pop((doc, piece))
            assert (r.start, r.length, r.ids_crc32) == (2048 * piece, len(part), zlib.crc32(part.tobytes()))
    assert not pieces
