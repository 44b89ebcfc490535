from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyhouse.llm import prefix_trie
from tallyhouse.llm.prefix_trie import conversation_trie, shared_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, conv string"


def words(text):
    return len((text or "").encode().split())


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    for node in members:
        if node:
            below[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in below[node]) or 1
        saved[node] = sum(saved[x] for x in below[node]) + (len(members[node]) - 1) * (words(node[-1][1]) if node else 0)
    return {
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(below[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    }


def talks(seed, n=120):
    draw, rows = random.Random(seed), []
    for c in range(n):
        if c % 17 == 3:
            continue
        size = draw.choice([1, 1, 2, 3, 5, 8, 13])
        for t in range(size):
            # few different texts, so that long beginnings are shared; a third are copies of one conversation
            text = f"word {t}" if c % 3 == 0 else " ".join(["a", "bb\x0bc", ""][: draw.randint(0, 2) + 1])
            rows.append((c, draw.choice([t, t, t, None]) if c % 3 else t, draw.choice(["user", "user", None]) if c % 3 else "user", text, 1, "clash"))
    rows += [(-7, 1, "user", "minus", 1, "x"), (None, 1, "user", "lost", 1, "x"), (200, 1, None, None, None, None), (200, 1, None, None, None, None)]
    rows += [(c, t, "user", f"long {t}", 1, None) for c in (300, 301, 302, 320) for t in range(40 + c % 3)]
    return rows


@pytest.mark.parametrize(("seed", "segment", "run"), [(1, 1024, 20_000), (2, 3, 5), (3, 1, 2), (4, 2, 20_000)])
def test_equals_brute_force(spark, monkeypatch, seed, segment, run):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "RUN_ROWS", run)
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = talks(seed)
    got = [tuple(r) for r in conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    want = brute(rows)
    assert len(got) == len(want) and set(got) == want


def test_turnless_and_empty(spark):
    # c = 1 replaces its first turns by those of an absent conversation
    few = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 1, "user", "only", None, None) for c in few]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in conversation_trie(frame).collect()}
    assert got == brute(rows) and len(got) == 1
    assert conversation_trie(frame.limit(0)).count() == 0


def test_shared_turns():
    a = bytes(range(16)) * 5
    assert shared_turns(a, a) == 5 and shared_turns(a, a[:48]) == 3 and shared_turns(a, b"") == 0
    for k in range(5):
        b = bytearray(a)
        b[16 * k + 15] ^= 1
        assert shared_turns(a, bytes(b)) == k
