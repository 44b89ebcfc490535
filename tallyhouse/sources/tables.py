"""Scans: Parquet tables, CSV files with a declared schema, catalog listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.functions.expressions import blank_missing


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table; a column list is pruned down to the reader."""
    frame = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def scan_csv(spark: SparkSession, path: str, schema: StructType, bad_rows: str | None = None) -> DataFrame:
    """CSV with a header and a declared schema.

    Cells are read as text, missing-value tokens become null, and each cell is then
    converted; a cell that does not convert is null and, when ``bad_rows`` names a
    column, that column lists the fields that failed.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    cells = {f.name: blank_missing(F.col(f.name)) for f in schema.fields}
    typed = [cells[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if bad_rows:
        failed = [
            F.when(cells[f.name].isNotNull() & cells[f.name].try_cast(f.dataType).isNull(), F.lit(f.name))
            for f in schema.fields
        ]
        typed.append(F.concat_ws(",", *failed).alias(bad_rows))
    return raw.select(*typed)


def require(spark: SparkSession, *paths: str) -> None:
    """Fail before any work when an input is missing."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        if not target.getFileSystem(conf).exists(target):
            raise FileNotFoundError(f"missing input {path}: run the step that writes it first")


def list_catalog(spark: SparkSession) -> DataFrame:
    """Tables and views of the current catalog, sorted by type and name."""
    rows = [
        ("view" if entry.tableType in ("VIEW", "TEMPORARY") else "table", entry.name)
        for entry in spark.catalog.listTables()
    ]
    return spark.createDataFrame(rows, "type string, name string").orderBy("type", "name")
