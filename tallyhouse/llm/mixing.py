"""Mix sources to target weights: tempered shares, realised by budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.config import stored
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

EVENNESS = 0.95
REPEATS = 4.0
BLOCK_TOKENS = 200_000
SEED = "mix-1"
STEPS = 30
MILLION = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def tempered_exponent(totals: DataFrame, evenness: float = EVENNESS, repeats: float = REPEATS) -> float | None:
    """The exponent of the shares, from one row per source with its ``tokens``.

    The entropy of the tempered shares falls as the exponent rises from 0 (even) to 1 (as
    they are), and so does the number of times the smallest source repeats. Bisection
    finds the largest exponent whose entropy is at least ``evenness`` of the highest
    possible one, then, if that repeats a source more than ``repeats`` times, the smallest
    exponent that does not. Five halvings are tried in one pass over the sources, whose
    number may grow. None without tokens.
    """
    counted = totals.where("tokens > 0")
    total, sources, least = counted.agg(F.sum("tokens"), F.count(F.lit(1)), F.min("tokens")).first()
    if not sources:
        return None
    log_share = F.log(F.col("tokens") / F.lit(float(total)))

    def entropies(exponents: list[float]) -> list[tuple[float, float]]:
        sums = []
        for a in exponents:
            power = F.exp(F.lit(a) * log_share)
            sums += [F.sum(power), F.sum(power * log_share)]
        row = counted.agg(*sums).first()
        return [(math.log(z) - a * s / z, z) for a, z, s in zip(exponents, row[::2], row[1::2], strict=True)]

    def bisect(low: float, high: float, upper_fails) -> tuple[float, float]:
        for _ in range(STEPS // 5):
            inner = [low + (high - low) * i / 32 for i in range(1, 32)]
            tests = [upper_fails(a, h, z) for a, (h, z) in zip(inner, entropies(inner), strict=True)]
            i = tests.index(True) if True in tests else 31
            low, high = ([low, *inner, high][i], [low, *inner, high][i + 1])
        return low, high

    wanted = evenness * math.log(sources)
    (whole, _), (_, even) = entropies([1.0, 0.0])
    exponent = 1.0
    if whole < wanted:
        exponent = bisect(0.0, 1.0, lambda a, h, z: h < wanted)[0]
    rare = math.log(least / total)

    def repeated(a: float, z: float) -> float:
        return math.exp((a - 1) * rare) / z

    if repeated(exponent, entropies([exponent])[0][1]) > repeats:
        exponent = bisect(exponent, 1.0, lambda a, h, z: repeated(a, z) <= repeats)[1]
    return round(exponent, 6)


def mixing_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget: int | None = None,
    evenness: float = EVENNESS,
    repeats: float = REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = SEED,
) -> DataFrame:
    """Each row as struct ``row`` with ``source``, ``n_tokens``, ``repeat_ppm``, ``block``, ``place`` and ``copies``.

    Tokens are words. A source whose tempered share of ``budget`` (default: all tokens)
    is r times its own tokens is read r times. Its documents are dealt by a hash into
    blocks of about ``block_tokens`` tokens, so that a source with a third of all rows is many
    small groups; each block is put into an order drawn by hash and has its own budget: every
    document r rounded down times, and once more from the front of the order as long as at
    least half of the document fits into what is left.

    A null source is a source of its own; a null text has no words; documents without words
    follow the same rule and cost nothing. Rows that agree in id share a place in the draw
    and are ordered arbitrarily. Columns of any name may be present. Without any words every
    row is taken once.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        docs[source_col].alias("source"),
        docs[id_col].cast("string").alias("_id"),
        word_count(docs[text_col]).alias("n_tokens"),
    )
    totals = stored(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    exponent = tempered_exponent(totals, evenness, repeats)
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    log_share = F.log(F.col("tokens") / F.lit(float(total or 1)))
    if exponent is None:
        ppm = F.lit(MILLION)
    else:
        z = totals.where("tokens > 0").agg(F.sum(F.exp(F.lit(exponent) * log_share))).first()[0]
        times = F.exp(F.lit(exponent - 1) * log_share) / F.lit(z) * F.lit((budget or total) / total)
        ppm = F.when(F.col("tokens") > 0, F.round(times * MILLION)).otherwise(MILLION)
    shares = totals.select(
        F.col("source").alias("_source"),
        ppm.cast("bigint").alias("repeat_ppm"),
        F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).cast("bigint").alias("_blocks"),
    )
    draw = F.md5(F.concat(F.coalesce("_id", F.lit("")), F.lit(f":{seed}")).cast("binary"))
    dealt = (
        rows.join(shares, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_draw", draw)
        .withColumn("block", F.shiftright(F.conv(F.substring("_draw", 1, 8), 16, 10).cast("bigint") * F.col("_blocks"), 32))
    )
    group = Window.partitionBy("source", "block")
    order = group.orderBy("_draw", "_id")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.floor(F.sum("n_tokens").over(group) * F.pmod(F.col("repeat_ppm"), F.lit(MILLION)) / MILLION)
    extra = (2 * F.col("_before") + F.col("n_tokens") <= 2 * F.col("_rest")) & (F.pmod(F.col("repeat_ppm"), F.lit(MILLION)) > 0)
    return dealt.withColumns(
        {"_before": before, "_rest": rest, "place": F.row_number().over(order) - 1}
    ).select(
        "row", "source", "n_tokens", "repeat_ppm", "block", "place",
        (F.floor(F.col("repeat_ppm") / MILLION).cast("bigint") + extra.cast("bigint")).alias("copies"),
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kwargs) -> DataFrame:
    """The rows of ``docs``, each as often as the plan takes it, with their columns."""
    plan = mixing_plan(docs, id_col, text_col, source_col, **kwargs).where("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


@query(
    "op5_mixing",
    f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens FROM documents
    ), t AS (
        SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source
    ), p AS (
        SELECT list(ln(tokens / (SELECT sum(tokens) FROM t)::DOUBLE) ORDER BY source) AS logs,
            {EVENNESS} * ln(count(*)) AS wanted FROM t WHERE tokens > 0
    ), bisect AS (
        SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, logs, wanted FROM p
        UNION ALL
        SELECT step + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END, logs, wanted
        FROM (
            SELECT *, ln(z) - mid * s / z >= wanted AS ok FROM (
                SELECT *, (low + high) / 2 AS mid,
                    list_sum(list_transform(logs, lambda x: exp((low + high) / 2 * x))) AS z,
                    list_sum(list_transform(logs, lambda x: x * exp((low + high) / 2 * x))) AS s
                FROM bisect WHERE step < {STEPS}
            )
        )
    ), tempered AS (
        SELECT logs, CASE WHEN -list_sum(list_transform(logs, lambda x: x * exp(x))) >= wanted THEN 1.0 ELSE low END AS a
        FROM bisect WHERE step = {STEPS}
    ), limited AS (
        SELECT 0 AS step, a AS low, 1.0::DOUBLE AS high, logs,
            exp((a - 1) * list_min(logs)) / list_sum(list_transform(logs, lambda x: exp(a * x))) > {REPEATS} AS over FROM tempered
        UNION ALL
        SELECT step + 1, CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END, logs, over
        FROM (
            SELECT *, (low + high) / 2 AS mid, exp(((low + high) / 2 - 1) * list_min(logs))
                / list_sum(list_transform(logs, lambda x: exp((low + high) / 2 * x))) <= {REPEATS} AS ok
            FROM limited WHERE step < {STEPS}
        )
    ), chosen AS (
        SELECT round((SELECT CASE WHEN over THEN high ELSE (SELECT a FROM tempered) END FROM limited WHERE step = {STEPS}), 6) AS a
    ), shares AS (
        SELECT source, CASE WHEN tokens > 0 THEN round(exp((a - 1) * ln(tokens / (SELECT sum(tokens) FROM t)::DOUBLE))
                / (SELECT sum(exp(a * ln(tokens / (SELECT sum(tokens) FROM t)::DOUBLE))) FROM t, chosen WHERE tokens > 0)
                * {MILLION}) ELSE {MILLION} END::BIGINT AS repeat_ppm,
            greatest(ceil(tokens / {BLOCK_TOKENS}), 1)::BIGINT AS blocks
        FROM t, chosen
    ), dealt AS (
        SELECT d.*, repeat_ppm, md5(doc_id::VARCHAR || ':{SEED}') AS draw,
            (('0x' || substr(md5(doc_id::VARCHAR || ':{SEED}'), 1, 8))::BIGINT * blocks) >> 32 AS block
        FROM d JOIN shares ON d.source IS NOT DISTINCT FROM shares.source
    ), placed AS (
        SELECT *, row_number() OVER w - 1 AS place,
            coalesce(sum(n_tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
            floor(sum(n_tokens) OVER (PARTITION BY source, block) * (repeat_ppm % {MILLION}) / {MILLION}) AS rest
        FROM dealt WINDOW w AS (PARTITION BY source, block ORDER BY draw, doc_id::VARCHAR)
    )
    SELECT doc_id, source, n_tokens, repeat_ppm, block, place::INTEGER AS place,
        (repeat_ppm // {MILLION} + (CASE WHEN repeat_ppm % {MILLION} > 0 AND 2 * earlier + n_tokens <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS copies
    FROM placed
    """,
)
def op5_mixing(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "source")
    return mixing_plan(docs).select("row.doc_id", "source", "n_tokens", "repeat_ppm", "block", "place", "copies")
