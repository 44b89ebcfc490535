"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Partition sizes and skew are settled at run time; only the ceilings are stated here.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is worth one more shuffle when splitting it would need one.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "256m",
}


# On a cluster exchanges start with many partitions, which are merged by their measured sizes:
# merging is cheap, but one that is too large is never split below an aggregation.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
}


def build_session(name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with these settings; give ``spark.checkpoint.dir`` on a cluster."""
    builder = SparkSession.builder.appName(name)
    local = (master or "").startswith("local")
    extra = extra if local else {**CLUSTER_SETTINGS, **extra}
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
