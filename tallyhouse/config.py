"""Run configuration and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Frames of at most this many rows may be held on the driver and broadcast.
SMALL_ROWS = 20_000


@dataclass(frozen=True)
class RunConfig:
    """Input files and the warehouse folder of one run."""

    features_csv: str
    targets_csv: str
    orders_csv: str
    warehouse: str
    seed: int = 42
    expected_rows: tuple[tuple[str, int | None], ...] = ()

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallyhouse-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_WATCHERS: list[list[str]] = []


@contextmanager
def watched_tables() -> Iterator[list[str]]:
    """The paths of what is stored inside the block, so that its owner can drop it later."""
    paths: list[str] = []
    _WATCHERS.append(paths)
    try:
        yield paths
    finally:
        _WATCHERS[:] = [w for w in _WATCHERS if w is not paths]


def drop_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove stored tables that nobody reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def paths_of(df: DataFrame) -> list[str]:
    """Where a frame that ``stored`` returned lies; nothing for others."""
    return list(getattr(df, "_stored_at", ()))


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove stored tables, and let Spark's cleaner remove the shuffle files of jobs that nobody refers to any more."""
    drop_tables(spark, paths)
    gc.collect()
    spark._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for paths in _WATCHERS:
        paths.append(path)
    return path


def local_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few literal rows as a local relation, so the planner knows they are few."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Cuts the lineage for work that passes over the rows several times; the table
    survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = (path,)
    return out


def settle(df: DataFrame, max_rows: int = SMALL_ROWS, heavy: bool = False) -> DataFrame:
    """Fix the content of an aggregated frame that several branches read.

    Up to ``max_rows`` rows become a local relation, whose true size the planner
    knows (so it is broadcast only because it is small); a larger frame is written
    to the shared folder and joined like any other table. A ``heavy`` frame, costly
    or likely large, is written before it is counted, so it is computed only once.
    """
    if heavy:
        df = stored(df)
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows:
        return df.sparkSession.createDataFrame(rows, df.schema)
    return df if heavy else stored(df)
