"""URL filter: rules first, then the likelihood ratio of two character models of accepted and rejected URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.config import stored
from tallyhouse.llm.common import UPPER, lower_ascii
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

# Characters of a context at most; a gram is a context and the character after it.
ORDER = 3
# The symbols that URLs are read in: letters, one for all digits, three separators, one for all else; 0 is a border.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0/.-_"
BASE = len(SYMBOLS) + 1
# Weight of the next shorter context in an estimate.
SMOOTHING = 4.0
# Scores are compared in hundredths; those beyond the last bin lie in it.
BINS = 1000
# One of so many URLs with a rule calibrates the threshold, the others train the models.
FOLDS = 5

# The rules of the query, as (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and where ``://`` is missing."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null without one.

    A rule fits its host and the subdomains of it where the path starts with the rule's. Of
    rules of one length that fit, the longer host wins, then the order given.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return name, verdict


def gram_codes(url: Column) -> Column:
    """A number for each character of a URL and its end: the symbol with the ``ORDER`` symbols before it."""
    text = F.translate(F.coalesce(url, F.lit("")), UPPER + "123456789", UPPER.lower() + "0" * 9)
    text = F.regexp_replace(text, r"(?s)[^a-z0/.\-]", "_")
    letters = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    border = F.array_repeat(F.lit(0), ORDER)
    symbols = F.concat(border, F.transform(letters, lambda c: F.instr(F.lit(SYMBOLS), c)), F.array(F.lit(0)))
    ends = F.sequence(F.lit(ORDER), F.char_length(text) + ORDER)
    # the symbols are bound once by a transform over one element
    return F.transform(
        F.array(symbols),
        lambda s: F.transform(ends, lambda i: sum((F.get(s, i - k) * BASE**k for k in range(ORDER + 1)), F.lit(0))),
    )[0]


def log_ratios(counted: DataFrame) -> DataFrame:
    """``code`` and ``ratio``: log of how much likelier the last symbol is in rejected URLs, given the ones before.

    Takes ``code``, ``accepted`` and ``rejected`` (times seen). Each model mixes an estimate
    with that of the next shorter context, down to equal chances for all symbols, so a context
    that was never seen has the estimate of its longest part that was. At most ``BASE`` to
    the power ``ORDER + 1`` rows.
    """
    kinds = ("accepted", "rejected")
    # one partition: as many rows at most as there are grams, and every sum below then needs a sort only
    frame = counted.coalesce(1)
    chance = {kind: F.lit(1.0 / BASE) for kind in kinds}
    for k in range(ORDER + 1):
        gram = F.col("code") % BASE ** (k + 1)
        context = Window.partitionBy(F.floor(gram / BASE))
        sums = {}
        for kind in kinds:
            sums[f"n{k}_{kind}"] = F.sum(kind).over(Window.partitionBy(gram))
            sums[f"m{k}_{kind}"] = F.sum(kind).over(context)
        frame = frame.withColumns(sums)
        chance = {x: (F.col(f"n{k}_{x}") + SMOOTHING * chance[x]) / (F.col(f"m{k}_{x}") + SMOOTHING) for x in kinds}
    return frame.select("code", (F.log(chance["rejected"]) - F.log(chance["accepted"])).alias("ratio"))


def url_scores(urls: DataFrame) -> DataFrame:
    """``no`` and ``bin`` (hundredths of the mean log ratio over a URL's symbols) from ``no``, ``url`` and ``train``.

    URLs have to be distinct; ``train`` is a verdict or null. A row of a symbol carries the number of its
    URL, not the URL. The ratios are broadcast: their number is bounded by the symbols, not by the URLs.
    """
    grams = urls.select("no", "train", F.explode(gram_codes(F.col("url"))).alias("code"))
    seen = [F.count(F.when(F.col("train") == say, 1)).alias(name) for say, name in (("allow", "accepted"), ("block", "rejected"))]
    ratios = stored(log_ratios(stored(grams.groupBy("code").agg(*seen), "grams")), "ratios")
    mean = F.round(F.avg("ratio"), 9)
    hundredths = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(mean * 100))).cast("int")
    return grams.join(F.broadcast(ratios), "code").groupBy("no").agg(hundredths.alias("bin"))


def threshold(tried: DataFrame) -> int:
    """The bin from which URLs are blocked, from ``bin`` and ``verdict`` of URLs that trained nothing.

    The sum of both error shares is smallest there; of equal bins the highest counts, and of
    the gap below it the middle. 0 where there are not both kinds. At most ``2 * BINS + 1``
    rows reach the driver.
    """
    counts = tried.groupBy("bin").agg(*[F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in ("allow", "block")])
    rows = sorted((r["bin"], r["allow"], r["block"]) for r in counts.collect())
    allowed, blocked = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not allowed or not blocked:
        return 0
    cut, least, below_a, below_b, before = 0, None, 0, 0, rows[0][0] - 1
    for at, a, b in [*rows, (rows[-1][0] + 1, 0, 0)]:
        wrong = below_b * allowed + (allowed - below_a) * blocked
        if least is None or wrong <= least:
            cut, least = (before + 1 + at) // 2, wrong
        below_a, below_b, before = below_a + a, below_b + b, at
    return cut


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``bin`` to pages.

    A rule that fits decides. All other URLs are judged by the ratio of two models of
    variable order, learned from every distinct URL that a rule accepts or rejects, but for one in
    ``FOLDS`` by its checksum: those set the threshold. The score is divided by the
    length. Null counts as empty: without a rule, and scored by its end alone. Where the rules accept or
    reject nothing, the threshold is 0 and a score of 0 or more is blocked only if both
    models exist; otherwise all URLs without a rule are allowed. Repeated URLs count once in the models.
    Columns of the five names are replaced; an empty table gives an empty table.
    """
    names = ["host", "path", "rule", "verdict", "bin"]
    kept = [c for c in pages.columns if c not in names]
    rows = pages.select(F.struct(*kept).alias("_row"), F.coalesce(pages[url_col], F.lit("")).alias("_url"))
    host, path = host_and_path(F.col("url"))
    urls = rows.select(F.col("_url").alias("url")).distinct().withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "verdict": verdict})
    urls = urls.withColumn("no", F.monotonically_increasing_id())
    urls = stored(urls.withColumn("train", F.when(F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("bigint") % FOLDS != 0, F.col("verdict"))), "urls")
    scored = stored(urls.join(url_scores(urls).hint("merge"), "no"), "scored")
    cut = threshold(scored.where("train is null and verdict is not null"))
    kinds = {r[0] for r in urls.where("train is not null").select("train").distinct().collect()}
    own = F.when(F.col("bin") >= cut, "block").otherwise("allow") if len(kinds) == 2 else F.lit("allow")
    judged = scored.select("url", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "bin")
    return rows.join(judged.hint("merge"), F.col("_url") == F.col("url")).select("_row.*", *names)


ORACLE = r"""
WITH urls AS (
    SELECT DISTINCT coalesce(url, '') AS url FROM pages
), rests AS (
    SELECT url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM urls
), split AS (
    SELECT url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
), rules(say, h, p) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
    SELECT url, arg_max(h || p, len(h || p)) AS rule, arg_max(say, len(h || p)) AS say
    FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY url
), folds AS (
    SELECT doc.url, host, path, rule, say, CASE WHEN ('0x' || substr(md5(doc.url), 1, 8))::BIGINT % 5 <> 0 THEN say END AS train
    FROM split doc LEFT JOIN fits ON fits.url = doc.url
), symbols AS (
    SELECT url, train, list_concat([0, 0, 0], CASE WHEN url = '' THEN [] ELSE list_transform(string_split(regexp_replace(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0/.\-]', '_', 'g'), ''),
        lambda c: instr('abcdefghijklmnopqrstuvwxyz0/.-_', c)) END, [0]) AS s
    FROM folds
), grams AS (
    SELECT url, train, unnest(list_transform(range(4, len(s) + 1), lambda i: s[i - 3] * 32768 + s[i - 2] * 1024 + s[i - 1] * 32 + s[i])) AS code FROM symbols
), counted AS (
    SELECT code, count(*) FILTER (train = 'allow') AS a, count(*) FILTER (train = 'block') AS b FROM grams GROUP BY code
), ratios AS (
    SELECT code,
        (b3 + 4 * (b2 + 4 * (b1 + 4 * (b0 + 4 / 32.0) / (mb0 + 4)) / (mb1 + 4)) / (mb2 + 4)) / (mb3 + 4) AS pb,
        (a3 + 4 * (a2 + 4 * (a1 + 4 * (a0 + 4 / 32.0) / (ma0 + 4)) / (ma1 + 4)) / (ma2 + 4)) / (ma3 + 4) AS pa
    FROM (SELECT code,
        sum(a) OVER (PARTITION BY code)::DOUBLE AS a3, sum(b) OVER (PARTITION BY code)::DOUBLE AS b3,
        sum(a) OVER (PARTITION BY code // 32)::DOUBLE AS ma3, sum(b) OVER (PARTITION BY code // 32)::DOUBLE AS mb3,
        sum(a) OVER (PARTITION BY code % 32768)::DOUBLE AS a2, sum(b) OVER (PARTITION BY code % 32768)::DOUBLE AS b2,
        sum(a) OVER (PARTITION BY code % 32768 // 32)::DOUBLE AS ma2, sum(b) OVER (PARTITION BY code % 32768 // 32)::DOUBLE AS mb2,
        sum(a) OVER (PARTITION BY code % 1024)::DOUBLE AS a1, sum(b) OVER (PARTITION BY code % 1024)::DOUBLE AS b1,
        sum(a) OVER (PARTITION BY code % 1024 // 32)::DOUBLE AS ma1, sum(b) OVER (PARTITION BY code % 1024 // 32)::DOUBLE AS mb1,
        sum(a) OVER (PARTITION BY code % 32)::DOUBLE AS a0, sum(b) OVER (PARTITION BY code % 32)::DOUBLE AS b0,
        sum(a) OVER ()::DOUBLE AS ma0, sum(b) OVER ()::DOUBLE AS mb0 FROM counted) t
), scored AS (
    SELECT url, greatest(-1000, least(1000, floor(round(avg(ln(pb) - ln(pa)), 9) * 100)))::INTEGER AS bin FROM grams JOIN ratios USING (code) GROUP BY url
), tried AS (
    SELECT bin, say FROM folds JOIN scored USING (url) WHERE train IS NULL AND say IS NOT NULL
), cuts AS (
    SELECT bin AS t FROM tried UNION SELECT max(bin) + 1 FROM tried
), wrong AS (
    SELECT t, (SELECT count(*) FROM tried WHERE say = 'block' AND bin < t) * (SELECT count(*) FROM tried WHERE say = 'allow')
        + (SELECT count(*) FROM tried WHERE say = 'allow' AND bin >= t) * (SELECT count(*) FROM tried WHERE say = 'block') AS e
    FROM cuts
), cut AS (
    SELECT CASE WHEN (SELECT count(DISTINCT say) FROM tried) = 2 THEN (
            SELECT floor((coalesce((SELECT max(bin) + 1 FROM tried WHERE bin < last), last) + last) / 2)
            FROM (SELECT max(t) AS last FROM wrong WHERE e = (SELECT min(e) FROM wrong)) w) ELSE 0 END AS t,
        (SELECT count(DISTINCT train) FROM folds) = 2 AS both_kinds
)
SELECT page_id, host, path, rule,
    coalesce(say, CASE WHEN both_kinds AND bin >= t THEN 'block' ELSE 'allow' END) AS verdict, bin
FROM pages JOIN folds ON folds.url = coalesce(pages.url, '') JOIN scored ON scored.url = folds.url CROSS JOIN cut
"""


@query("op13_url_filter", ORACLE)
def op13_url_filter(spark, folder):
    return judge_urls(table(spark, folder, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "bin")
