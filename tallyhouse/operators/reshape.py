"""Shares, crosstabs, pivots with fixed columns, reindexing, stacking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions.expressions import percent


def group_count(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key; rows with a null key are left out."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_share(df: DataFrame, *keys: str, name: str = "pct") -> DataFrame:
    """Rows per key and their share of all counted rows, in percent.

    The total is a scalar subquery over the counts, so many keys never meet in one task.
    """
    counts = group_count(df, *keys)
    return counts.withColumn(name, percent(F.col("count"), counts.agg(F.sum("count")).scalar()))


def crosstab(df: DataFrame, row: str, column: str, order: Sequence[str]) -> DataFrame:
    """Counts per row value with one column per listed value; absent pairs are 0."""
    present = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return present.groupBy(row).pivot(column, list(order)).agg(F.count(F.lit(1))).na.fill(0)


def crosstab_percent(df: DataFrame, row: str, column: str, order: Sequence[str]) -> DataFrame:
    """Row percentages; the denominator is every non-null column value, listed or not."""
    present = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return present.groupBy(row).agg(
        *[percent(F.count_if(F.col(column) == v), F.count(F.lit(1))).alias(str(v)) for v in order]
    )


def pivot_measure(df: DataFrame, row: str, column: str, order: Sequence[str], measure: Column) -> DataFrame:
    """An aggregate per row value and listed column value; absent pairs stay null."""
    present = df.where(F.col(row).isNotNull())
    return present.groupBy(row).pivot(column, list(order)).agg(measure)


def reindex(df: DataFrame, key: str, order: Sequence[str], position: str = "position") -> DataFrame:
    """One row per listed key in that order, null measures where ``df`` has none."""
    spark = df.sparkSession
    wanted = spark.range(len(order)).select(
        F.col("id").cast("int").alias(position),
        F.element_at(F.array(*[F.lit(v) for v in order]), (F.col("id") + 1).cast("int")).alias(key),
    )
    return wanted.join(df, key, "left")


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def stack_offsets(df: DataFrame, row: str, position: str, value: str) -> DataFrame:
    """Start of each stacked part: the sum of the parts before it in the row."""
    earlier = Window.partitionBy(row).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("bottom", F.coalesce(F.sum(value).over(earlier), F.lit(0.0)))


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale profile columns to 0..1 over all rows of a profile; a constant column is null."""
    everyone = Window.partitionBy(F.lit(0))
    scaled = {}
    for c in columns:
        low, high = F.min(c).over(everyone), F.max(c).over(everyone)
        scaled[c] = F.try_divide(F.col(c) - low, high - low)
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])
