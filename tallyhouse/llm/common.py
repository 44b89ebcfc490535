"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.config import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.

    Text of single bytes takes Spark's fast path, which does the same for it.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def with_starts(df: DataFrame, order_by: Sequence[Column], totals: dict[str, Column], parts: int) -> DataFrame:
    """Add for each row the sums of all rows before it in ascending order, for each of ``totals``.

    Rows are range partitioned over ``parts`` ranges and stored, so that a range is one
    bounded task whatever the keys are; sums inside a range come from a window over that
    range, what precedes it from one row per range. The order has to be unique.
    """
    kept = df.columns
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order_by)]
    wide = df.select("*", *keys, *[c.cast("bigint").alias(f"_t_{n}") for n, c in totals.items()])
    ordered = [F.col(f"_o{i}") for i in range(len(keys))]
    blocks = stored(wide.repartitionByRange(parts, *ordered).withColumn("_block", F.spark_partition_id()), "ranges")
    sums = [F.sum(f"_t_{n}").alias(f"_s_{n}") for n in totals]
    earlier = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.groupBy("_block").agg(*sums).select(
        "_block", *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in totals]
    )
    inside = Window.partitionBy("_block").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    starts = [
        (F.col(f"_b_{n}") + F.coalesce(F.sum(f"_t_{n}").over(inside), F.lit(0))).alias(n) for n in totals
    ]
    return blocks.join(F.broadcast(before), "_block").select(*kept, *starts)


def ranges_for(df: DataFrame) -> int:
    """How many ranges to deal rows into: the session's shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def drawn(key: Column, wanted: int, rows: int) -> Column:
    """Whether a hash of ``key`` draws a row when about ``wanted`` of ``rows`` are wanted, and a little more.

    So a bounded sample is cut out before anything is sorted or sent, however many tasks there are.
    """
    share = min(1.0, 1.2 * wanted / max(rows, 1) + 20 / max(rows, 1))
    return F.shiftrightunsigned(F.xxhash64(F.lit("sample"), key), 11) < int(share * 2**53)


def bounded_batches(spark, rows: int = 500) -> None:
    """Keep the Arrow batches of texts small, because one text may be very long.

    Leaves a smaller value of the session alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` after whose last batch the Python worker gives freed memory back.

    Workers go on to other stages, so what the allocators keep would add up on an executor.
    """

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run
