"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.config import drop_tables, paths_of, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for edges ``a``, ``b`` of one type.

    Alternates large-star and small-star steps: every node hands its larger (then its
    smaller) neighbours to its smallest one, until only stars are left, after a number of
    rounds that grows with the logarithm of the longest path. The smallest neighbour is an
    aggregate that is joined back, so a node with very many neighbours is never gathered. Each
    round is one stored table, and the one before is dropped. Edges from a node to itself and repeated edges are harmless; null
    ends are left out; without edges there are no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "edges")
    while not _all_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")).hint("merge"), "u")
        ends = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        past, edges = edges, stored(small.select(ends.alias("e")).select("e.*").where("u <> v").distinct(), "edges")
        drop_tables(edges.sparkSession, paths_of(past))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _all_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is nobody's smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").isEmpty()
