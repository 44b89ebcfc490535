"""Personal data, also in disguise: texts are normalised by transducers that keep offsets."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tallyhouse.llm.common import bounded_batches
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

KINDS = ("email", "ip", "card", "phone")
# Fewer spelled digits in a row than this are prose.
SPELLED_RUN = 4

# Letters that look like Latin ones, digit words, and the forms of at and dot.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕһԁԛԝкмтвнАВЕКМНОРСТУХІЈЅαορνικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijshdqwkmtbhABEKMHOPCTYXIJSaopviktuxABEZHIKMNOPTYX",
        strict=True,
    )
)
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4",
    "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
AT, DOT = "at|arroba|arobase", "dot|punkt|punto|point"

WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
SPELLED = re.compile(rf"(?:\bplus[ -]+)?\b(?:{WORD})(?:[ -]+(?:{WORD}))" + f"{{{SPELLED_RUN - 1},}}" + r"\b", re.I)
BRACKETED = re.compile(rf"[\[({{<][ ]*(?:(?P<at>{AT}|@)|(?P<dot>{DOT}|\.))[ ]*[\])}}>][ ]*", re.I)
SPELLED_DOT = rf"(?: +(?:{DOT}) +| *[\[({{<] *(?:{DOT}|\.) *[\])}}>] *)"
DOMAIN_WORDS = rf"[A-Za-z0-9-]+(?:(?:{SPELLED_DOT}|\.)[A-Za-z0-9-]+)+"
SPACED = re.compile(rf" (?<=[A-Za-z0-9 ] )(?P<sign>(?:{AT}) +){DOMAIN_WORDS}", re.I)
LOOSE = re.compile(rf"(?P<sign>@ *){DOMAIN_WORDS}", re.I)
DOMAIN_DOT = re.compile(SPELLED_DOT, re.I)
SPACED_DOT = re.compile(rf" +(?:{DOT}) +", re.I)
DOTTED = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?: +(?:{DOT}) +[0-9]{{1,3}}){{3}}", re.I)
UNUSUAL = re.compile("[^\x00-\xac\xae-\u036f]")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def find_plain(text: str) -> list[Span]:
    """Spans written as they are, by kind in the order of ``KINDS``, then by start."""
    found: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:  # one step per sign, so a long run of letters is not tried from each of them
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append(("email", start, last))
        at = text.find("@", max(at + 1, last))
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.groups()):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = [int(c) for c in m.group() if c not in " -"] if m.end() - m.start() < 64 else []
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
                found.append(("phone", *m.span()))
    return found


def _luhn(digits: list[int]) -> bool:
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(doubled) + sum(digits[-1::-2])) % 10 == 0


class Mapped:
    """A rewritten text and, for each of its characters, the span of source characters it stands for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts: np.ndarray | None = None
        self.ends: np.ndarray | None = None

    def rewrite(self, pattern: re.Pattern, write: Callable[[re.Match], list[tuple[int, int, str]]]) -> None:
        """Replace in each match the (start, end) pieces that ``write`` names; every new character stands for its whole piece."""
        edits = sorted({e for m in pattern.finditer(self.text) for e in write(m)})
        if not edits:
            return
        if self.starts is None:
            self.starts = np.arange(len(self.text))
            self.ends = self.starts + 1
        texts, starts, ends, at = [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:a], new]
            low = self.starts[a] if a < b else 0
            high = self.ends[b - 1] if a < b else 0
            starts += [self.starts[at:a], np.full(len(new), low)]
            ends += [self.ends[at:a], np.full(len(new), high)]
            at = b
        self.text, self.starts, self.ends = "".join(texts), np.concatenate(starts), np.concatenate(ends)


def _plain_character(c: str) -> str | None:
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.digit(c, None) if c.isdecimal() else None
    return None if digit is None else str(digit)


def _letters(m: re.Match) -> list[tuple[int, int, str]]:
    if m.group() in INVISIBLE:
        return [(m.start(), m.end(), "")]
    new = _plain_character(m.group())
    return [] if new is None else [(m.start(), m.end(), new)]


def _blanks(text: str, a: int) -> int:
    """Where the blanks before ``a`` start."""
    while a and text[a - 1] == " ":
        a -= 1
    return a


def _local_dots(text: str, at: int) -> list[tuple[int, int, bool]]:
    """Start, end and whether in brackets of the spelled dots in the local part that ends before ``at``."""
    found = []
    while True:
        word = at
        while word and text[word - 1] in LOCAL:
            word -= 1
        end = _blanks(text, word)
        bracketed = 0 < end < at and text[end - 1] in "])}>"
        if bracketed:
            end = _blanks(text, end - 1)
        start = end
        while start and end - start < 6 and (text[start - 1].isalpha() or text[start - 1] == "." and bracketed):
            start -= 1
        dot, before = text[start:end].lower(), _blanks(text, start)
        if bracketed:
            if not before or text[before - 1] not in "[({<" or dot not in (".", *DOT.split("|")):
                return found
            before = _blanks(text, before - 1)
        elif end == word or before == start or dot not in DOT.split("|"):
            return found
        if word == at or not before or text[before - 1] not in LOCAL:
            return found
        found.append((before, word, bracketed))
        at = before


def _sign(m: re.Match) -> list[tuple[int, int, str]]:
    """The dots in brackets are matches themselves."""
    start = _blanks(m.string, m.start())
    dots = [(a, b, ".") for a, b, bracketed in _local_dots(m.string, start) if not bracketed] if m.group("at") else []
    return [*dots, (start, m.end(), "@" if m.group("at") else ".")]


def _spaced(m: re.Match) -> list[tuple[int, int, str]]:
    """A spelled or spaced sign counts only before a spelled dot; prose around a plain one stays as it is."""
    start, end = _blanks(m.string, m.start() + 1 if m.string[m.start()] == " " else m.start()), m.end("sign")
    dots = [(*d.span(), ".") for d in DOMAIN_DOT.finditer(m.string, end, m.end())]
    if not dots:
        return []
    sign = [] if m.string[start:end] == "@" else [(start, end, "@")]
    return [(a, b, ".") for a, b, _ in _local_dots(m.string, start)] + sign + dots


def _dotted(m: re.Match) -> list[tuple[int, int, str]]:
    return [(m.start() + d.start(), m.start() + d.end(), ".") for d in SPACED_DOT.finditer(m.group())]


def _spelled(m: re.Match) -> list[tuple[int, int, str]]:
    edits, last = [], m.start()
    for w in re.finditer(rf"plus|{WORD}", m.group(), re.I):
        a, b = m.start() + w.start(), m.start() + w.end()
        edits.append((last, b, DIGIT_WORDS.get(w.group().lower(), "+")))
        last = b
    return edits


def _has_run(text: str) -> bool:
    """Whether two digit words stand side by side, blanks around them, as in any long enough run."""
    before = False
    for w in text.lower().replace("-", " ").split():
        now = w in DIGIT_WORDS
        if now and before:
            return True
        before = now
    return False


def _has_dot(text: str) -> bool:
    return any(f" {d} " in text.lower() for d in DOT.split("|"))


# Pattern, what it writes, and a quick test without which the pattern cannot match.
STEPS = (
    (UNUSUAL, _letters, lambda t: not t.isascii()),
    (SPELLED, _spelled, _has_run),
    (SPACED, _spaced, lambda t: True),
    (BRACKETED, _sign, lambda t: any(c in t for c in "[({<")),
    (LOOSE, _spaced, lambda t: "@" in t),
    (DOTTED, _dotted, _has_dot),
)


def find_disguised(text: str, plain: list[Span]) -> list[Span]:
    """Spans that only the normalised text shows, in source characters; none lies inside a plain one of its kind."""
    mapped = Mapped(text)
    for pattern, write, possible in STEPS:
        if possible(mapped.text):
            mapped.rewrite(pattern, write)
    if mapped.text == text:
        return []
    # plain spans of a kind do not overlap, so only the last one that starts at or before a span may hold it
    firsts = {kind: sorted((s, e) for k, s, e in plain if k == kind) for kind in KINDS}
    found = []
    for kind, a, b in find_plain(mapped.text):
        start, end = int(mapped.starts[a]), int(mapped.ends[b - 1])
        if text[start:end] != mapped.text[a:b]:
            before = bisect_right(firsts[kind], (start, math.inf))
            if not before or firsts[kind][before - 1][1] < end:
                found.append((kind, start, end))
    return found


def find_personal(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``spans``: kind, start, end (code points, end exclusive), value, and whether it was disguised.

    Plain spans follow fixed patterns, leftmost and without overlap per kind; a match that
    fails its check (octets, Luhn, number of digits) is dropped without another try.
    Then lookalike and full-width characters, invisible characters, digits spelled out
    four or more in a row, and disguises of the at sign and the dot are rewritten, each
    new character remembering the source characters it stands for, and the same
    patterns run again. Such a span is added unless it lies inside a plain one of its kind,
    so it may contain a plain span that is only a part of the identifier. A spelled at sign
    counts only before a spelled or bracketed dot, as "look at example.com" is prose.

    Whole texts are read; null counts as empty and has no spans. Spans come by kind, then
    start. Other columns stay; a column ``spans`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != "spans"]
    at = names.index(text_col)
    kept = docs.select(*names)
    fields = [
        StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
        StructField("value", StringType()), StructField("disguised", BooleanType()),
    ]
    schema = StructType([*kept.schema.fields, StructField("spans", ArrayType(StructType(fields)))])
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("disguised", pa.bool_())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(at).to_pylist():
                text = text or ""
                plain = find_plain(text)
                spans = [(*s, False) for s in plain] + [(*s, True) for s in find_disguised(text, plain)]
                spans.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                rows.append([{"kind": k, "start": a, "end": b, "value": text[a:b], "disguised": d} for k, a, b, d in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kinds)], schema.names)

    return kept.mapInArrow(find, schema)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op3_personal_data")
def op3_personal_data(spark, folder):
    found = find_personal(table(spark, folder, "documents", "doc_id", "text"))
    spans = F.col("spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(k) for k in KINDS]
    base = F.filter(spans, lambda s: ~s["disguised"])
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))
