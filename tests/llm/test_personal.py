from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from tallyhouse.llm import personal
from tallyhouse.llm.personal import find_disguised, find_personal, find_plain, op3_personal_data


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_plain_against_patterns():
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choice("a.@-+_ 0129()é") for _ in range(draw.randint(0, 40)))
        assert find_plain(text) == brute(text)
        find_disguised(text, [])


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("write john (at) mail dot com now", "email", "john (at) mail dot com"),
        ("jane[at]corp[dot]com", "email", "jane[at]corp[dot]com"),
        ("jane at corp dot co dot uk.", "email", "jane at corp dot co dot uk"),
        ("é аnna@mаil.com", "email", "аnna@mаil.com"),
        ("call plus one two three four five six seven eight nine end", "phone", "plus one two three four five six seven eight nine"),
        ("ip 97 dot 51 dot 17 dot 173.", "ip", "97 dot 51 dot 17 dot 173"),
        ("９７.51.17.173", "ip", "９７.51.17.173"),
        ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card", None),
    ],
)
def test_disguises_map_back(text, kind, value):
    found = find_disguised(text, find_plain(text))
    assert [(k, text[a:b]) for k, a, b in found] == [(kind, value or text)]


@pytest.mark.parametrize("text", ["we meet at noon. then", "one two three", "the dot (at the end) of it", "user @ host. Next", "a (b) c"])
def test_prose_stays_clean(text):
    assert find_disguised(text, find_plain(text)) == []


def test_operator_edges(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "a@b.co and a (at) b (dot) co", None), (None, "+1 (017) 555-7713", "z"), (5, "a" * 200_000 + "@x.org", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    out = find_personal(docs)
    assert out.columns == ["doc_id", "text", "spans"]
    got = {r.doc_id: r.spans for r in out.collect()}
    assert got[1] == got[2] == []
    assert [(s.value, s.disguised) for s in got[3]] == [("a@b.co", False), ("a (at) b (dot) co", True)]
    assert [s.kind for s in got[None]] == ["phone"] and got[5][0].end == 200_006
    assert find_personal(docs.limit(0)).count() == 0


def test_query_against_patterns(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op3_personal_data(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = [f"{k}:{a}:{b}" for k, a, b in brute(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(","))or not want
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len([s for s in r.spans.split(",") if s])


@pytest.mark.parametrize(
    ("text", "base", "whole"),
    [
        ("to jоhn@mail.com.", "hn@mail.com", "jоhn@mail.com"),
        ("to a@x.cоm now", "a@x.c", "a@x.cоm"),
        ("to jane@corp.example dot com", "jane@corp.example", "jane@corp.example dot com"),
        ("to john dot doe at mail dot com", None, "john dot doe at mail dot com"),
        ("to a dot b (dot) c at mail dot com", None, "a dot b (dot) c at mail dot com"),
        ("to a dot b (dot) c (at) mail.com", None, "a dot b (dot) c (at) mail.com"),
        ("jane at corp[dot]com", None, "jane at corp[dot]com"),
    ],
)
def test_disguised_spans_are_whole(text, base, whole):
    plain = find_plain(text)
    assert [text[a:b] for _, a, b in plain] == ([base] if base else [])
    assert [(k, text[a:b]) for k, a, b in find_disguised(text, plain)] == [("email", whole)]


@pytest.mark.parametrize("text", ["look at example.com or at b.org", "jоin a@b.co today", "one at a.b.c at d dot"])
def test_at_before_a_plain_dot_is_prose(text):
    assert find_disguised(text, find_plain(text)) == []


def test_time_grows_with_the_text():
    text = "a@b.co and x at y dot com, " * 80_000
    began = time.time()
    plain = personal.find_plain(text)
    found = personal.find_disguised(text, plain)
    assert len(found) == 80_000 and len(plain) >= 80_000
    assert time.time() - began < 60
