from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import components, ngram_join
from tallyhouse.llm.components import connected_components
from tallyhouse.llm.ngram_join import Blocks, Ngrams, drop_near_copies, near_components, overlap_links

SCHEMA = "doc_id bigint, text string, key string, n int"


def shingles(text, words):
    w = (text or "").encode().lower().split()
    k = min(words, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, words, percent):
    sets = [shingles(r[1], words) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return {r[0]: (len(sets[i]), least[find(i)]) for i, r in enumerate(rows)}


def family(draw, start, base, members, most):
    rows = []
    for i in range(members):
        words = list(base)
        for _ in range(draw.randint(0, most)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((start + i, " ".join(words)))
    return rows


def corpus(seed):
    draw = random.Random(seed)
    rows = []
    for f in range(12):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.choice([2, 5, 9, 15, 40, 120]))]
        rows += family(draw, 1000 * (f + 1), base, draw.randint(1, 12), max(1, len(base) // 15))
    passage = " ".join(f"p{i}" for i in range(50))
    rows += [(50_000 + i, passage + " " + " ".join(f"u{draw.randrange(10**6)}" for _ in range(30))) for i in range(15)]
    rows += [(60_001, None), (60_002, ""), (60_003, " \t\n"), (60_004, "a\x1cb c"), (60_005, "One"), (60_006, "one "), (60_007, "one two")]
    return rows


@pytest.mark.parametrize(("words", "percent", "tile", "hot"), [(3, 90, 256, 256), (5, 80, 3, 256), (5, 80, 4, 1)])
def test_components(spark, monkeypatch, words, percent, tile, hot):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rows = corpus(words)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, words=words, percent=percent).collect()}
    assert got == brute(rows, words, percent)


@pytest.mark.parametrize(("size", "most", "times"), [(500, 3, 4), (100, 1, 4), (100, 9, None)])
def test_large_family_in_tiles(spark, monkeypatch, size, most, times):
    """Rows that enter the product of a family of near copies grow with its classes, not with their square."""
    monkeypatch.setattr(ngram_join, "TILE", 20)
    monkeypatch.setattr(ngram_join, "HOT", 50)
    entered, product = [], ngram_join._product
    monkeypatch.setattr(ngram_join, "_product", lambda dealt, *rest: (entered.append(dealt.count()), product(dealt, *rest))[1])
    draw = random.Random(9)
    base = [f"w{draw.randrange(10**6)}" for _ in range(size)]
    rows = family(draw, 1, base, 400, most)
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs).collect()}
    assert got == brute(rows, 3, 90)
    if times:
        assert sum(entered) < times * len({r[1] for r in rows})


def test_repeated_and_null_ids(spark):
    text = "a b c d e f g"
    rows = [(1, text), (1, text), (1, "other words here now"), (None, text), (None, "lonely words are here"), (2, text)]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = near_components(docs).collect()
    assert len(got) == len(rows)
    assert sorted(str(r.component_id) for r in got if r.n_shingles == 5) == ["1"] * 4
    assert near_components(docs.limit(0)).count() == 0


def test_drop(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(3, base), (2, base + " more"), (9, None), (8, ""), (7, "quite different words in this one")]
    docs = spark.createDataFrame([(*r, "k", 5) for r in rows], SCHEMA)
    out = drop_near_copies(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [2, 7, 8, 9]


@pytest.mark.parametrize("percent", [90, 80])
def test_blocks_miss_no_link(percent):
    draw = random.Random(percent)
    blocks, tried = Blocks(percent), 0
    while tried < 500:
        a = {draw.getrandbits(64) for _ in range(draw.choice([1, 2, 8, 20, 100, 300]))}
        b = set(a)
        for _ in range(draw.randint(0, max(1, len(a) // 6))):
            b = b - {draw.choice(sorted(b))} if draw.random() < 0.5 and len(b) > 1 else b | {draw.getrandbits(64)}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        linked = 100 * len(a & b) >= percent * len(a | b)
        assert overlap_links([x], [y], percent)[0, 0] == linked
        if linked:
            tried += 1
            assert len(np.intersect1d(blocks.keys(x), blocks.keys(y)))


def test_very_long_words_and_texts():
    grams = Ngrams(3)
    for text in ("w" + "é x" * 900_000 + " end", "z" * 3_000_000 + " q r s", "A a\x0ba\x0ca  a"):
        assert len(grams.of(text)) == len(shingles(text, 3))


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(5, 5), (7, 6), (200, 300)]
    rows = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert rows == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_words_around_a_giant_one_hash_as_elsewhere():
    prose = " ".join(f"w{i}" for i in range(1, 5001))
    alone = ngram_join.word_hashes(prose.encode())
    assert len(np.unique(alone)) == 5000
    for size in (1 << 20, (1 << 20) - len(prose) - 1, 3_000_000):
        giant = ngram_join.word_hashes(b"z" * size)
        assert len(giant) == 1
        got = ngram_join.word_hashes(f"{prose} {'z' * size} {prose}".encode())
        assert np.array_equal(got, np.concatenate([alone, giant, alone]))
    draw = random.Random(7)
    words = ["".join(draw.choice("abc") for _ in range(draw.choice([1, 3, 9, 400_000, 2_500_000]))) for _ in range(12)]
    single = [ngram_join.word_hashes(w.encode())[0] for w in words]
    assert ngram_join.word_hashes("\n ".join(words).encode()).tolist() == single
    # what sums of the bytes say without stretches
    word = words[0][:50].encode()
    want = sum(int(ngram_join.BYTE_CODES[c]) * pow(int(ngram_join.M2), i, 1 << 64) for i, c in enumerate(word)) % (1 << 64)
    assert ngram_join.word_hashes(word)[0] == ngram_join.mixed(np.array([want], np.uint64))[0]
    far = ngram_join.word_hashes(("q " * 600_000 + "end").encode())
    assert far[-1] == ngram_join.word_hashes(b"end")[0] and len(np.unique(far)) == 2


def test_giant_word_keeps_links(spark):
    prose = " ".join(f"w{i}" for i in range(900))
    rows = [(1, f"{prose} {'A' * 3_000_000}"), (2, f"{prose} {'B' * 1_000_000}"), (3, "other words of a text")]
    docs = spark.createDataFrame([(*r, "k", 5) for r in rows], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs).collect()}
    assert got == brute(rows, 3, 90)
    assert got[1][1] == got[2][1] == 1


def test_sets_of_settled_groups_are_left_behind(spark, monkeypatch):
    """Products after the first one shuffle only the sets of groups that are still open."""
    monkeypatch.setattr(ngram_join, "TILE", 3)
    held, product = [], ngram_join._product
    monkeypatch.setattr(ngram_join, "_product", lambda dealt, sets, *rest: (held.append(sets.count()), product(dealt, sets, *rest))[1])
    rows = corpus(5)
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, words=5, percent=80).collect()}
    assert got == brute(rows, 5, 80)
    assert len(held) == 3 and held[0] > held[1] == held[2] > 0


def apart(draw, start, base, members):
    """Texts that share keys but lack too many of the base's n-grams for a link."""
    rows = []
    for i in range(members):
        words = list(base)
        for j in draw.sample(range(5, len(words) - 5, 5), draw.randint(4, 5)):
            words[j] = f"x{draw.randrange(10**9)}"
        rows.append((start + i, " ".join(words)))
    return rows


def test_members_without_a_partner_leave_their_group(spark, monkeypatch):
    """Members of a large group that are linked with nobody do not meet all others of it."""
    monkeypatch.setattr(ngram_join, "TILE", 20)
    entered, product = [], ngram_join._product
    monkeypatch.setattr(ngram_join, "_product", lambda dealt, *rest: (entered.append(dealt.count()), product(dealt, *rest))[1])
    draw = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = apart(draw, 1, base, 300) + family(draw, 1000, base, 60, 1)
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, words=5, percent=80).collect()}
    assert got == brute(rows, 5, 80)
    assert sum(entered) < 2 * len(rows)


@pytest.mark.parametrize("flush", [50, 10**6])
def test_unshared_ngrams_of_members(monkeypatch, flush):
    monkeypatch.setattr(ngram_join, "FLUSH", flush)
    draw = random.Random(3)
    sets = {(i, g): sorted(draw.sample(range(400), draw.randint(1, 60))) for g in (-5, 7) for i in range(1 + 50 * g, 13 + 50 * g)}
    columns = [[i for i, _ in sets], [g for _, g in sets], [np.array(v, np.uint64).tobytes() for v in sets.values()]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "g", "grams"])
    scattered = pa.Table.from_batches(ngram_join._scattered(2)([batch.slice(0, 9), batch.slice(9)])).sort_by("bucket")
    got = {}
    for b in ngram_join._unshared(iter(scattered.combine_chunks().to_batches())):
        for i, n in zip(*b.to_pydict().values(), strict=True):
            got[i] = got.get(i, 0) + n
    held = Counter((g, x) for (_, g), v in sets.items() for x in v)
    want = {i: sum(held[g, x] == 1 for x in v) for (i, g), v in sets.items()}
    assert got == {i: n for i, n in want.items() if n}


@pytest.mark.parametrize("parts", [1, 3])
def test_unshared_rows_and_bytes_of_members(parts):
    """A member is one row for each part of its group, whatever the number of buckets, and an n-gram few bytes."""
    draw = random.Random(6)
    common = sorted(draw.sample(range(1 << 60), 40))
    sets = {i: common + [draw.getrandbits(62) for _ in range(300)] for i in range(200)}
    columns = [list(sets), [i % 5 for i in sets], [np.array(v, np.uint64).tobytes() for v in sets.values()]]
    names = ["id", "g", "grams"]
    if parts > 1:
        columns, names = [*columns, [parts] * len(sets)], [*names, "parts"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
    scattered = pa.Table.from_batches(ngram_join._scattered(6)([batch])).sort_by("bucket").combine_chunks()
    rows = [(i, n) for b in ngram_join._unshared(iter(scattered.to_batches())) for i, n in zip(*b.to_pydict().values(), strict=True)]
    assert len(rows) <= parts * len(sets)
    got = Counter()
    for i, n in rows:
        got[i] += n
    assert got == dict.fromkeys(sets, 300)
    entries = 300 * len(sets) + 5 * len(common)
    assert sum(len(b) for c in ("keys", "owners") for b in scattered.column(c).to_pylist()) <= 5 * entries + 16 * parts * len(sets)


def test_groups_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_GRAMS", 50)
    rows = corpus(5)
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, words=5, percent=80).collect()}
    assert got == brute(rows, 5, 80)


def test_sets_are_shuffled_once(spark, monkeypatch):
    """While members without a partner are looked for, neither texts nor sets lie in shuffle files beside the stored sets."""

    def shuffled(since):
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        sizes = {files.apply(i).getName(): files.apply(i).length() for i in range(files.length())}
        return {f: n for f, n in sizes.items() if f.startswith("shuffle_") and int(f.split("_")[1]) > since}

    since = max([-1, *(int(f.split("_")[1]) for f in shuffled(-1))])
    seen, kept = {}, ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name="stored": (kept(df, name), seen.setdefault(name, sum(shuffled(since).values())))[0])
    draw = random.Random(8)
    rows = [r for f in range(20) for r in family(draw, 100 * f, [f"w{draw.randrange(10**6)}" for _ in range(3000)], 12, 9)]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(4)
    got = {r.doc_id: r.component_id for r in near_components(docs, words=5, percent=80).collect()}
    assert got == {i: i // 100 * 100 for i, _ in rows}
    assert seen["members"] < 8 * sum(len(t.split()) for _, t in rows) / 2


def test_components_store_one_table_a_round(spark, monkeypatch):
    names, kept = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, name="stored": (names.append(name), kept(df, name))[1])
    edges = [(i, i + 1) for i in range(1, 40)]
    rows = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r.node, r.root) for r in rows} == {(i, 1) for i in range(1, 41)}
    assert set(names) == {"edges"} and len(names) < 9
