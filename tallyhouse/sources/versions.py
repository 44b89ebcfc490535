"""Tables that readers see whole or not at all: versions in folders of their own, and a manifest replaced last."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

MANIFEST = "_manifest"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def manifest(spark: SparkSession, path: str) -> dict | None:
    """``parts`` (folders of the current content, oldest first) and ``loads`` (ids of the writes in it); None before the first."""
    fs, where = _fs(spark, f"{path}/{MANIFEST}")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, content: dict) -> None:
    """Write the new manifest beside the old one and rename it over it, in one step of the file system."""
    fs, draft = _fs(spark, f"{path}/{MANIFEST}-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    option = hadoop.Options.Rename
    over = spark._sc._gateway.new_array(option, 1)
    over[0] = option.OVERWRITE
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, hadoop.Path(f"{path}/{MANIFEST}"), over)


def _written(df: DataFrame, path: str, partition_by: Sequence[str]) -> tuple[str, int]:
    part, seen = f"version-{uuid.uuid4().hex}", Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by)
    writer.parquet(f"{path}/{part}")
    return part, int(seen.get["rows"])


def replace(df: DataFrame, path: str, load_id: str | None = None, partition_by: Sequence[str] = ()) -> int:
    """Replace the table and return the rows written.

    A write that fails leaves the old version in place and readable; readers that have begun
    keep their version, because old folders stay until ``vacuum``. ``df`` may read the table itself.
    """
    part, rows = _written(df, path, partition_by)
    _switch(df.sparkSession, path, {"parts": [part], "loads": [load_id] if load_id else []})
    return rows


def append_once(df: DataFrame, path: str, load_id: str, partition_by: Sequence[str] = ()) -> int:
    """Add rows under an id; a load that is already part of the table is left as it is and adds 0 rows."""
    spark = df.sparkSession
    if load_id in (manifest(spark, path) or {"loads": []})["loads"]:
        return 0
    part, rows = _written(df, path, partition_by)
    # what others have added meanwhile stays: the manifest is read again just before the switch
    now = manifest(spark, path) or {"parts": [], "loads": []}
    if load_id in now["loads"]:
        return 0
    _switch(spark, path, {"parts": [*now["parts"], part], "loads": [*now["loads"], load_id]})
    return rows


def current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current version."""
    found = manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of {path} has been finished")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*[f"{path}/{p}" for p in found["parts"]])


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove folders that the manifest does not name: old versions and what failed writes left. Returns their names.

    Only while nobody writes or reads an old version.
    """
    keep = set((manifest(spark, path) or {"parts": []})["parts"])
    fs, where = _fs(spark, path)
    gone = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("version-") and s.getPath().getName() not in keep]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName() for p in gone)
