"""Writers: append, truncate and reload, idempotent key insert, counted writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import StructType


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition together, so that not every task writes a file to each of them.

    Rebalancing splits a partition above the advisory size over several tasks, so one
    that holds a large share of the rows is still written in parallel.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _gathered(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), only_present: bool = False) -> None:
    """Replace the table; with ``only_present`` just the partitions that ``df`` has rows of."""
    mode = "dynamic" if only_present else "static"
    writer = _gathered(df, partition_by).write.mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", mode).parquet(path)


def write_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write and return the row count of the same pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return int(seen.get["rows"])


def new_keys(incoming: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key."""
    return incoming.dropDuplicates(list(key)).join(existing.select(*key).distinct(), list(key), "left_anti")


def create_table(spark, name: str, schema: StructType, path: str | None = None) -> None:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{location}")
