from __future__ import annotations

import duckdb
import pytest

from tallyhouse.llm.licenses import LEAST, TEMPLATES, anchors, bigrams, license_matches, op2_license_scan, scan_licenses
from tallyhouse.plans.registry import ORACLES


def dice(a, b):
    a, b = set(bigrams(a)), set(bigrams(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_anchors_are_needed():
    words = set(anchors(TEMPLATES))
    for text in TEMPLATES.values():
        kept = [b for b in bigrams(text) if not words & set(b.split())]
        assert 2 * len(kept) < LEAST * (len(kept) + len(bigrams(text)))


def test_matches(spark):
    texts = [
        "prose here.\nReleased under the MIT License.\nmore prose",
        "It is RELEASED under the MIT licence!",
        "released UNDER  the,MIT   License",
        "Licensed under the Apache License, Version 2.0. And then prose goes on",
        TEMPLATES["MIT-text"].replace(", ", ",\n"),
        "the license of this lake is not known to anyone under the sun",
        None, "", "license", "license " * 50_000,
    ]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id int, text string, licenses string")
    out = scan_licenses(docs)
    assert out.columns == ["doc_id", "text", "licenses"]
    got = {r.doc_id: sorted({m.license for m in r.licenses}) for r in out.collect()}
    assert got == {0: ["MIT"], 1: ["MIT"], 2: ["MIT"], 3: ["Apache-2.0"], 4: ["MIT-text"], 5: [], 6: [], 7: [], 8: [], 9: []}
    for r in out.collect():
        for m in r.licenses:
            assert m.dice == pytest.approx(dice(m.unit, TEMPLATES[m.license]))
    assert scan_licenses(docs.limit(0)).count() == 0
    assert docs.select(license_matches(docs["text"], {"x": "one"}).alias("m")).where("size(m) > 0").count() == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = con.execute(ORACLES["op2_license_scan"]).fetchall()
    got = [tuple(r) for r in op2_license_scan(spark, folder).collect()]
    assert sorted(got) == sorted(want) and sum(r[1] > 0 for r in got) > 5


def test_wrapped_notices(spark):
    notice = "This work is licensed under the GNU General\n{}Public License, version 3."
    texts = [
        "Some prose before it. " + notice.format("") + " More text of the same\nparagraph goes on and on.",
        "# A file of something.\n# " + notice.format("# ") + " More text\n# goes on.",
        "// Of the lake and the\n// sea\n//\n// Released under the\n// MIT License\n//\n// and of the land",
        "Some prose before\nit goes on",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: sorted({(m.license, m.dice) for m in r.licenses}) for r in scan_licenses(docs).collect()}
    assert {i: max(g, default=None, key=lambda m: m[1]) for i, g in got.items()} == {
        0: ("GPL-3.0", 1.0), 1: ("GPL-3.0", 1.0), 2: ("MIT", 1.0), 3: None
    }
