"""Run registered queries next to their SQL twins in DuckDB and compare the values."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def kind(value: str) -> str:
    return {"int64": "int64", "int32": "int32"}.get(value, value)


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None when both hold the same columns, types and rows in any order."""
    left, right = left[sorted(left.columns)], right[sorted(right.columns)]
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} / {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for c in left.columns:
        if left[c].dtype != right[c].dtype and not (left[c].isna().any() or right[c].isna().any()):
            if not (left[c].dtype.kind in "OM" and right[c].dtype.kind in "OM"):
                return f"type of {c}: {left[c].dtype} / {right[c].dtype}"
    text = lambda df: sorted(tuple("null" if pd.isna(v) else str(v) for v in row) for row in df.astype(object).values.tolist())
    a, b = text(_plain(left)), text(_plain(right))
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def _plain(df: pd.DataFrame) -> pd.DataFrame:
    out = df.copy()
    for c in out.columns:
        if out[c].dtype.kind == "M":
            out[c] = out[c].dt.strftime("%Y-%m-%d")
        elif out[c].dtype.kind in "iu":
            out[c] = out[c].astype(float)
    return out


def run(names: list[str], folder: str, spark) -> int:
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    con = duck(folder)
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
            spent = time.time() - start
            problem = None
            if name in oracles:
                problem = difference(got, con.execute(oracles[name]).df())
        except Exception as error:  # noqa: BLE001
            spent = time.time() - start
            problem = "".join(traceback.format_exception_only(error))[:700]
            got = []
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {spent:6.2f}s rows={len(got)} {'' if name in oracles else '(no sql)'} {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sys.exit(1 if run(sys.argv[2:], sys.argv[1], session) else 0)
