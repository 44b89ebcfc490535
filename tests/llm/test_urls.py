from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

from tallyhouse.llm import urls
from tallyhouse.llm.urls import judge_urls

SCHEMA = "page_id bigint, url string, host string, bin string"

CASES = [
    ("http://Shop.EXAMPLE.com/en/1", "shop.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/x?q=/a", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
    ("https://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("ftp://x.net/es/#t", "x.net", "/es/", "net/es/", "block"),
    ("http://net/fr/2", "net", "/fr/2", "net/fr/", "block"),
]
UNRULED = [
    ("http://x.net/de/2", "x.net", "/de/2"),
    ("http://x.com", "x.com", ""),
    ("http://x.com?u=http://y.net/es/", "x.com", ""),
    ("x.com/en", "", ""),
    ("://", "", ""),
    ("", "", ""),
    (None, "", ""),
    ("http://a\n.org/é\nü/#", "a\n.org", "/é\nü/"),
    ("http://xn.org:80/a?b", "xn.org:80", "/a"),
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, c[0], "clash", "clash") for i, c in enumerate([*CASES, *UNRULED])]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, case in enumerate(CASES):
        assert (got[i].url, got[i].host, got[i].path, got[i].rule, got[i].verdict) == case
    for i, case in enumerate(UNRULED, len(CASES)):
        assert (got[i].url, got[i].host, got[i].path, got[i].rule) == (*case, None)
        assert got[i].verdict in ("allow", "block")


def pages(words_a, words_b, n):
    rows = [(i, f"http://h{i % 7}.com/{words_a[i % len(words_a)]}/{i}", None, None) for i in range(n)]
    rows += [(n + i, f"http://h{i % 5}.net/es/{words_b[i % len(words_b)]}/{i}", None, None) for i in range(n)]
    return rows


def test_models_separate_what_rules_leave(spark):
    good, bad = ["garden", "kitchen", "history", "music"], ["xxcasinoxx", "qqpokerqq", "zzbetzz"]
    rows = pages(good, bad, 200)
    asked = [(9001, "http://h.org/garden/history", None, None), (9002, "http://h.org/es/xxcasinoxx/qqpokerqq", None, None)]
    # the text of a page is longer than one buffer, and a third of all rows repeat one URL
    asked += [(9003, "http://h.org/" + "casino" * 30_000, None, None)] + [(9100 + i, "http://h.org/kitchen", None, None) for i in range(200)]
    got = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(rows + asked, SCHEMA).repartition(5)).collect()}
    assert len(got) == len(rows) + len(asked)
    assert got[9001] == "allow" and got[9002] == "block" and {got[9100 + i] for i in range(200)} == {"allow"}


def brute(all_urls, rules):
    """Mean log ratio of each URL by dictionaries of counts."""

    def symbols(u):
        out = [0] * 3
        for c in u:
            c = c.lower() if "A" <= c <= "Z" else c
            c = "0" if c in "123456789" else c
            at = urls.SYMBOLS.find(c) + 1
            out.append(at if at else len(urls.SYMBOLS))
        return [*out, 0]

    counts = {"allow": Counter(), "block": Counter()}
    for u in set(all_urls):
        if rules.get(u):
            s = symbols(u)
            for i in range(3, len(s)):
                for k in range(4):
                    counts[rules[u]][("g", *s[i - k : i + 1])] += 1
                    counts[rules[u]][("c", k, *s[i - k : i])] += 1

    def chance(c, s, i):
        p = 1 / 32
        for k in range(4):
            p = (c[("g", *s[i - k : i + 1])] + 4 * p) / (c[("c", k, *s[i - k : i])] + 4)
        return p

    out = {}
    for u in set(all_urls):
        s = symbols(u)
        logs = [math.log(chance(counts["block"], s, i) / chance(counts["allow"], s, i)) for i in range(3, len(s))]
        out[u] = sum(logs) / len(logs)
    return out


def test_scores_equal_brute_force(spark):
    rows = pages(["aa", "b-c"], ["zz.9", "Q_é"], 40) + [(900, "http://c.org/Aa/1", None, None), (901, "", None, None)]
    frame = spark.createDataFrame([(i, u, "allow" if ".com" in u else "block" if ".net" in u else None) for i, u in enumerate({r[1] for r in rows})], "no int, url string, train string")
    got = {r.url: r.bin for r in urls.url_scores(frame).join(frame, "no").collect()}
    want = brute([r[1] for r in rows], {r.url: r.train for r in frame.collect()})
    assert got == {u: math.floor(round(v, 9) * 100) for u, v in want.items()}


def test_threshold(spark):
    def cut(rows):
        return urls.threshold(spark.createDataFrame(rows, "bin int, verdict string"))

    assert cut([(-5, "allow"), (2, "allow"), (7, "block"), (9, "block")]) == 5
    assert cut([(-5, "allow"), (8, "allow"), (7, "block"), (9, "block")]) == 9
    assert cut([(1, "block"), (1, "block")]) == 0
    assert cut([(3, "block"), (4, "allow")]) == 5


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, "http://a.org/x", None, None), (1, "http://a.org/x", None, None)]])
def test_small_tables(spark, rows):
    got = judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.verdict for r in got] == ["allow"] * len(rows)


def test_sql_agrees_on_edges(spark, tmp_path):
    rows = [(i, c[0], None, None) for i, c in enumerate([*CASES, *UNRULED])] + [(r[0] + 100, *r[1:]) for r in pages(["aa", "bb"], ["cc"], 30)]
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.select("page_id", "url").write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    got = {tuple(r) for r in judge_urls(frame.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "bin").collect()}
    assert got == set(con.execute(urls.ORACLE).fetchall())
