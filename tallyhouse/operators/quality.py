"""Data-quality checks: row counts, orphan keys, nulls, uniqueness, domains, verdict."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int | None]) -> DataFrame:
    """``table, expected, rows, status``: ok, fail, or info where nothing is expected."""
    counted = _stack(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"),
                F.lit(expected.get(name)).cast("long").alias("expected"),
                "rows",
            )
            for name, df in tables.items()
        ]
    )
    status = (
        F.when(F.col("expected").isNull(), "info").when(F.col("expected") == F.col("rows"), "ok").otherwise("fail")
    )
    return counted.withColumn("status", status)


def orphans(
    checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """``relation, broken``: fact rows whose key is null or unknown.

    Fact rows are counted per key before the anti join, so a hot key is one row.
    """
    counted = []
    for relation, fact, fk, dim, pk in checks:
        per_key = fact.groupBy(F.col(fk).alias("fk")).agg(F.count(F.lit(1)).alias("n"))
        known = dim.select(F.col(pk).alias("pk"))
        counted.append(
            per_key.join(known, F.col("fk") == F.col("pk"), "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("broken"))
            .select(F.lit(relation).alias("relation"), "broken")
        )
    return _stack(counted)


def nulls(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """``table, column, nulls`` for all columns in one pass."""
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one_row.unpivot([], list(columns), "column", "nulls").select(
        F.lit(name).alias("table"), "column", "nulls"
    )


def duplicates(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """``table, key, duplicate_keys, extra_rows``; rows with a null key part do not collide."""
    present = df
    for k in key:
        present = present.where(F.col(k).isNotNull())
    repeated = present.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("extra_rows"),
    ).select(F.lit(name).alias("table"), F.lit(",".join(key)).alias("key"), "duplicate_keys", "extra_rows")


def domain_violations(df: DataFrame, name: str, rules: dict[str, str]) -> DataFrame:
    """``table, rule, violations``; as in SQL, a rule that yields null is not violated."""
    one_row = df.agg(*[F.count_if(~F.expr(rule)).alias(label) for label, rule in rules.items()])
    return one_row.unpivot([], list(rules), "rule", "violations").select(
        F.lit(name).alias("table"), "rule", "violations"
    )


def verdict(checks: Sequence[DataFrame]) -> DataFrame:
    """``checks, failed, all_ok`` over frames with a boolean column ``passed``."""
    return _stack([c.select("passed") for c in checks]).agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_ok"),
    )
