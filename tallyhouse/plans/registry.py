"""Named queries: a DataFrame function and, where SQL can say it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round computed doubles, so that the order of summation cannot show."""
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(c, places).alias(c) if c in doubles else F.col(c) for c in df.columns])
