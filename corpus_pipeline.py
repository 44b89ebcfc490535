"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept;
between stages the rows are written and read again. Stages are pure: ``run`` drops what a stage has
stored for its own use once its rows are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.config import paths_of, release, stored, watched_tables
from tallyhouse.llm.exact_dedup import drop_copies
from tallyhouse.llm.language import keep_identified
from tallyhouse.llm.mixing import mix_sources
from tallyhouse.llm.ngram_join import drop_near_copies
from tallyhouse.llm.packing import pack, token_pieces
from tallyhouse.plans.registry import query
from tallyhouse.sources.tables import table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; null texts and texts without letters go."""
    return keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the document with the largest id."""
    return drop_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a Jaccard similarity of 0.8 or more, the smallest id."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at tempered weights within a budget of as many words as there are; a row may repeat."""
    return mix_sources(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048."""
    return pack(token_pieces(docs))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_similar),
    ("mixing", mix),
    ("packing", pack_sequences),
]

# A trained network and the packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with watched_tables() as left:
            docs = stored(stage(spark, docs, sf_dir), name)
        release(spark, set(left) - set(paths_of(docs)))
    return docs
