"""Registers the queries of all text operators."""

from tallyhouse.llm import (  # noqa: F401
    exact_dedup,
    fingerprints,
    hard_negatives,
    language,
    licenses,
    mixing,
    ngram_join,
    packing,
    personal,
    prefix_trie,
    sharding,
    toxicity,
    urls,
)
