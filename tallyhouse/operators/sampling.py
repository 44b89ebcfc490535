"""Seeded sampling that does not depend on the layout of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.config import settle
from tallyhouse.functions.expressions import hash_key
from tallyhouse.operators.stats import profile, ranked_values, value_at_rank


def sample_fixed(df: DataFrame, identity: str, size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (or all): those with the smallest hash of id and seed."""
    return (
        df.withColumn("_hash", hash_key(F.col(identity), seed))
        .orderBy("_hash", identity)
        .limit(size)
        .drop("_hash")
    )


def stratified_split(
    df: DataFrame,
    label: str,
    identity: str,
    train_share: float = 0.8,
    seed: int = 42,
    accuracy: int = 10_000,
) -> DataFrame:
    """Add ``split``: in each class exactly the rounded share of rows is ``train``.

    Train rows are those with the smallest hashes of their class. The hash at the cut
    is found by exact rank selection, so no class is ever sorted in one task.
    """
    hashed = df.withColumn("_hash", hash_key(F.col(identity), seed))
    keyed = hashed.select(label, "_hash")
    brackets = settle(profile(keyed, ["_hash"], [label], [train_share], accuracy))
    ranked = ranked_values(keyed, brackets, ["_hash"], [label], [train_share])
    rank = F.floor(F.lit(train_share) * F.col("n") + 0.5)
    cuts = settle(
        ranked.groupBy(label, "n")
        .agg(value_at_rank(rank).alias("cut"))
        .select(label, F.coalesce(F.col("cut"), F.when(rank < 1, F.lit(-1.0))).alias("_cut"))
    )
    missed = F.raise_error(F.lit("the cut of a class lies outside its bracket; raise the accuracy")).cast("double")
    return (
        hashed.join(cuts.withColumn("_cut", F.coalesce("_cut", missed)), label)
        .withColumn("split", F.when(F.col("_hash") <= F.col("_cut"), "train").otherwise("test"))
        .select(*df.columns, "split")
    )
