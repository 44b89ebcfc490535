"""License scans: normalised text against templates by Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

LEAST = 0.8

# Notices by which works name their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Distributed under the terms of the BSD 2-Clause License.",
    "BSD-3-Clause": "Distributed under the terms of the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, normalised as texts are."""
    words = re.sub(r"[^\w]+|_", " ", text.lower().replace("licence", "license")).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def anchors(templates: Mapping[str, str], least: float = LEAST) -> list[str]:
    """Words of which any text at ``least`` from any template holds one.

    Without the bigrams of these words too few of a template are left to reach the bound,
    however well the rest agrees. Longer words, which prose seldom holds, come first, then
    those that many templates share.
    """
    left = {name: set(bigrams(t)) for name, t in templates.items()}
    sizes = {name: len(b) for name, b in left.items()}
    chosen: list[str] = []
    while True:
        # with o shared bigrams and no others in the text the coefficient is 2 o / (o + size)
        open_ = [n for n, b in left.items() if sizes[n] and 2 * len(b) >= least * (len(b) + sizes[n])]
        if not open_:
            return sorted(chosen)
        worth: dict[str, int] = {}
        for n in open_:
            for word in {w for b in left[n] for w in b.split()}:
                worth[word] = worth.get(word, 0) + 1
        best = max(worth, key=lambda w: (len(w) > 4, worth[w], len(w), w))
        chosen.append(best)
        for n in left:
            left[n] = {b for b in left[n] if best not in b.split()}


def normalised(text: Column) -> Column:
    """Lower-cased words, single blanks between them; both spellings of license are one."""
    plain = F.regexp_replace(F.lower(text), "licence", "license")
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def license_matches(text: Column, templates: Mapping[str, str] | None = None, least: float = LEAST) -> Column:
    """Array of (unit, license, dice): the units of a text that are like a template.

    Units are sentences, within a line and wrapped over several, lines, blocks between blank
    lines or comment lines without words, and the whole text. A unit is
    compared only with templates whose number of bigrams its own allows to reach
    ``least``; of several, the one with the highest coefficient counts, the first by name on ties.
    Texts without an anchor word are not cut at all. Null and empty texts have no matches.
    """
    templates = templates or TEMPLATES
    known = {n: bigrams(t) for n, t in sorted(templates.items()) if bigrams(t)}
    if not known:
        return F.expr("cast(array() as array<struct<unit:string,license:string,dice:double>>)")
    low, high = least / (2 - least), (2 - least) / least
    table_ = F.array(
        *[
            F.struct(
                F.lit(n).alias("license"), F.array(*[F.lit(x) for x in b]).alias("bigrams"),
                F.lit(math.ceil(low * len(b) - 1e-9)).alias("least"), F.lit(math.floor(high * len(b) + 1e-9)).alias("most"),
            )
            for n, b in known.items()
        ]
    )
    bounds = min(math.ceil(low * len(b) - 1e-9) for b in known.values()), max(math.floor(high * len(b) + 1e-9) for b in known.values())
    # lines that hold a comment mark only are blank; a sentence is wrapped if words stand on both sides of a line break
    bare = F.regexp_replace(text, r"(?<![^\n])[ \t]*(?:/{2,}|/?\*+/?|#+|-{2,}|;+|%+)[ \t\r]*(?=\n|\z)", "")
    wrapped = F.split(bare, r"\n[ \t\r]*\n|(?<=[.!?])[ \t\r\f\n]+")
    units = F.array_distinct(
        F.concat(
            F.filter(wrapped, lambda u: u.rlike(r"[\p{L}\p{N}][^\n\p{L}\p{N}]*\n[^\p{L}\p{N}]*[\p{L}\p{N}]")),
            F.split(bare, r"\n[ \t\r]*\n"),
            F.split(F.regexp_replace(text, r"([.!?])[ \t\r\f]+", "$1\n"), "\n"),
            F.split(text, r"\n"),
            F.split(text, r"\n[ \t\r]*\n"),
            F.array(text),
        )
    )

    def pairs(words: Column) -> Column:
        return F.array_distinct(
            F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), words[i + 1]))
        )

    cut = F.transform(units, lambda u: F.struct(u.alias("unit"), F.split(normalised(u), " ").alias("words")))
    short = F.filter(cut, lambda u: (F.size(u["words"]) > bounds[0]) & (F.size(F.array_distinct(u["words"])) <= bounds[1] + 1))
    paired = F.transform(short, lambda u: F.struct(u["unit"].alias("unit"), pairs(u["words"]).alias("pairs")))

    def best(u: Column) -> Column:
        size = F.size(u["pairs"])
        near = F.filter(table_, lambda t: size.between(t["least"], t["most"]))
        dice = F.transform(
            near,
            lambda t: F.struct(
                (F.lit(-2.0) * F.size(F.array_intersect(u["pairs"], t["bigrams"])) / (size + F.size(t["bigrams"]))).alias("minus"),
                t["license"].alias("license"),
            ),
        )
        return F.array_min(dice)

    scored = F.transform(paired, lambda u: F.struct(u["unit"].alias("unit"), best(u).alias("best")))
    found = F.filter(scored, lambda u: u["best"]["minus"] <= -least + 1e-12)
    result = F.transform(
        found, lambda u: F.struct(u["unit"].alias("unit"), u["best"]["license"].alias("license"), (-u["best"]["minus"]).alias("dice"))
    )
    words = "|".join(w.replace("license", "licen[cs]e") for w in anchors(templates, least))
    none = F.expr("cast(array() as array<struct<unit:string,license:string,dice:double>>)")
    held = rf"(?:^|[^\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"
    return F.when(F.coalesce(F.lower(text).rlike(held), F.lit(False)), result).otherwise(none)


def scan_licenses(
    docs: DataFrame, text_col: str = "text", templates: Mapping[str, str] | None = None, least: float = LEAST
) -> DataFrame:
    """Add ``licenses``: the matches of each whole text. Rows stay as they are, a column of that name is replaced.

    Everything is computed inside the row; nothing is shuffled.
    """
    names = [c for c in docs.columns if c != "licenses"]
    return docs.select(*names, license_matches(docs[text_col], templates, least).alias("licenses"))


def _oracle() -> str:
    known = {n: bigrams(t) for n, t in sorted(TEMPLATES.items())}
    values = ", ".join(f"('{n}', [{', '.join(repr(x) for x in b)}])" for n, b in known.items())
    return rf"""
    WITH templates(license, bigrams) AS (VALUES {values}),
    d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    units AS (
        SELECT DISTINCT doc_id, unit FROM (
            SELECT doc_id, unnest(list_concat(
                string_split(regexp_replace(text, '([.!?])[ \t\r\f]+', '\1' || chr(10), 'g'), chr(10)),
                list_concat(string_split(text, chr(10)), list_concat(string_split_regex(text, '\n[ \t\r]*\n'), [text]))
            )) AS unit FROM d
        )
    ), words AS (
        SELECT doc_id, unit, string_split(trim(regexp_replace(replace(lower(unit), 'licence', 'license'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w
        FROM units WHERE unit <> ''
    ), pairs AS (
        SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM words
        WHERE len(w) < 2000
    ), scored AS (
        SELECT doc_id, unit, license, 2.0 * len(list_intersect(p, bigrams)) / (len(p) + len(bigrams)) AS dice
        FROM pairs, templates
        WHERE len(p) >= {LEAST / (2 - LEAST)} * len(bigrams) - 1e-9 AND len(p) <= {(2 - LEAST) / LEAST} * len(bigrams) + 1e-9
    ), matched AS (
        SELECT doc_id, unit, license, dice FROM scored WHERE dice >= {LEAST} - 1e-12
        QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, license) = 1
    ), grouped AS (
        SELECT doc_id, count(*) AS n_units, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, round(max(dice), 6) AS best_dice
        FROM matched GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_units, 0)::INTEGER AS n_units, coalesce(licenses, '') AS licenses, coalesce(best_dice, 0.0) AS best_dice
    FROM d LEFT JOIN grouped USING (doc_id)
    """


@query("op2_license_scan", _oracle())
def op2_license_scan(spark, folder):
    found = scan_licenses(table(spark, folder, "documents", "doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"])))
    dice = F.coalesce(F.array_max(F.transform("licenses", lambda m: m["dice"])), F.lit(0.0))
    return found.select(
        "doc_id", F.size("licenses").alias("n_units"), F.array_join(names, ",").alias("licenses"), F.round(dice, 6).alias("best_dice")
    )
