"""Exact duplicates by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.config import paths_of, release, stored, watched_tables
from tallyhouse.llm.common import lower_ascii
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table

FIRST_BYTES = 64
DIGIT_GROWTH = 16


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: Sequence[str] | None = None,
    normalise: Callable[[Column], Column] = lower_ascii,
) -> DataFrame:
    """Add ``keep_id``, ``group_size`` and ``kept``: of equal normalised texts one row stays.

    Documents are split by their bytes from the front. The first digit is 64 bytes, every
    further one 16 times longer, so the number of passes is the logarithm of the longest
    text. A group is (bytes so far, whether the text ended there); a group of one row is
    settled, a group that has ended holds equal texts, the rest goes into the next pass.
    No digest takes part. Groups are counted and stored before rows meet them, so a text with a
    third of all rows is one partial count per task, and the join back to the rows is one
    that the engine may split; it is a merge join at every size.

    The row with the largest id stays; among rows that share that id one does, and a null
    id is smaller than any other. Null text counts as empty. ``keep_id`` is null only where
    all ids of the group are. ``columns`` (default: all) are returned as they came, under
    their names; the three new columns replace columns of the same name. An empty table
    gives an empty table.
    """
    columns = [c for c in columns or docs.columns if c not in ("keep_id", "group_size", "kept")]
    return _marked(docs, id_col, text_col, columns, normalise).select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], "keep_id", "group_size", "kept"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per normalised text, the one that ``mark_copies`` keeps, with the columns of ``docs``.

    The rows that stay are stored, so that what the passes have stored goes at once.
    """
    names = [F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)]
    with watched_tables() as left:
        kept = stored(_marked(docs, id_col, text_col, docs.columns, lower_ascii).where("kept").select(*names), "single")
    release(docs.sparkSession, set(left) - set(paths_of(kept)))
    return kept


def _marked(
    docs: DataFrame, id_col: str, text_col: str, columns: Sequence[str], normalise: Callable[[Column], Column]
) -> DataFrame:
    """``columns`` as ``_c0``, ``_c1`` ..., so that no name can clash, and the three new columns."""
    carried = [f"_c{i}" for i in range(len(columns))]
    extra = [] if text_col in columns else [docs[text_col].alias("_text")]
    text = F.col("_text" if extra else f"_c{list(columns).index(text_col)}")
    rows = docs.select(
        *[docs[c].alias(f"_c{i}") for i, c in enumerate(columns)],
        docs[id_col].alias("_id"),
        *extra,
        F.substring(normalise(docs[text_col]).cast("binary"), 1, FIRST_BYTES).alias("_lead"),
    )
    leads = rows.groupBy("_lead").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    level = stored(
        rows.join(stored(leads, "leads").hint("merge"), "_lead", "left").select(
            *carried,
            "_id",
            F.monotonically_increasing_id().alias("_no"),
            F.when(F.col("_n").isNotNull(), normalise(text).cast("binary")).alias("_key"),
        ),
        "radix",
    )
    settled = level.where("_key is null").select(
        *carried, F.col("_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept")
    )
    unsettled, width = level.where("_key is not null"), FIRST_BYTES * DIGIT_GROWTH
    while True:
        ended = F.length("_key") <= width
        rows = unsettled.select(
            *carried, "_id", "_no", "_key", F.substring("_key", 1, width).alias("_bytes"), ended.alias("_ended")
        )
        groups = rows.groupBy("_bytes", "_ended").agg(
            F.count(F.lit(1)).alias("_n"), F.max(F.struct("_id", "_no")).alias("_top")
        )
        more = (F.col("_n") > 1) & ~F.col("_ended")
        level = stored(
            rows.join(stored(groups, "groups").hint("merge"), ["_bytes", "_ended"]).select(
                *carried, "_id", "_no", "_n", "_top", F.when(more, F.col("_key")).alias("_key")
            ),
            "radix",
        )
        settled = settled.unionByName(
            level.where("_key is null").select(
                *carried,
                F.col("_top._id").alias("keep_id"),
                F.col("_n").alias("group_size"),
                (F.col("_top._no") == F.col("_no")).alias("kept"),
            )
        )
        unsettled, width = level.where("_key is not null"), width * DIGIT_GROWTH
        if unsettled.isEmpty():
            break
    return settled


@query(
    "op1_exact_dedup",
    """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents
    ), g AS (
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
            count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256
        FROM d
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
)
def op1_exact_dedup(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(lower_ascii(F.col("text")), 256))
    return mark_copies(docs, columns=["doc_id", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
