"""Row numbers, running totals and ranks that do not need one task to see all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.config import SMALL_ROWS, stored


def _in_blocks(df: DataFrame, order_by: Sequence[str], max_rows: int, heavy: bool) -> DataFrame:
    """Fixed content plus ``block``: ascending ranges of ``order_by``.

    A small frame is one block. A larger one is range partitioned and stored, so every
    branch that reads it sees the same ranges. The input is stored first unless it is
    light, because finding the ranges reads it once more.
    """
    if heavy:
        df = stored(df)
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows:
        return df.sparkSession.createDataFrame(rows, df.schema).withColumn("block", F.lit(0))
    return stored(df.repartitionByRange(*order_by).withColumn("block", F.spark_partition_id()), "ranges")


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    totals: dict[str, str],
    keys: Sequence[str] = (),
    max_rows: int = SMALL_ROWS,
    heavy: bool = True,
) -> DataFrame:
    """Add inclusive running sums ``{new column: summed column}`` in ascending order.

    Sums inside a block come from a window over that block, what precedes the block
    from the block totals (one row per block and key).
    """
    fixed = _in_blocks(df, [*keys, *order_by], max_rows, heavy)
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        fixed.groupBy(*keys, "block")
        .agg(*[F.sum(c).alias(f"_t_{new}") for new, c in totals.items()])
        .select(
            *keys,
            "block",
            *[F.coalesce(F.sum(f"_t_{new}").over(earlier), F.lit(0)).alias(f"_s_{new}") for new in totals],
        )
    )
    inside = (
        Window.partitionBy(*keys, "block")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return fixed.join(starts, [*keys, "block"]).select(
        *df.columns,
        *[(F.col(f"_s_{new}") + F.sum(c).over(inside)).alias(new) for new, c in totals.items()],
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str], name: str, max_rows: int = SMALL_ROWS, heavy: bool = True
) -> DataFrame:
    """1, 2, 3 ... in ascending order; the order must be unique."""
    return running_totals(df.withColumn("_one", F.lit(1)), order_by, {name: "_one"}, (), max_rows, heavy).drop("_one")


def average_rank(value: str, *partition: str) -> Column:
    """Rank in ascending order where ties share the mean of their ranks.

    For profile frames with few rows per partition, such as one row per segment.
    """
    ordered = Window.partitionBy(*partition).orderBy(value)
    tied = Window.partitionBy(*partition, value)
    return F.rank().over(ordered) + (F.count(F.lit(1)).over(tied) - 1) / F.lit(2.0)


def winner(df: DataFrame, value: str, tie: str, largest: bool = True) -> DataFrame:
    """The row with the largest (or smallest) value; ties go to the smallest ``tie``."""
    order = F.col(value).desc_nulls_last() if largest else F.col(value).asc_nulls_last()
    return df.orderBy(order, F.col(tie).asc()).limit(1)
