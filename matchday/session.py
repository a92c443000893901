"""Session settings the operators are written for."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Skewed shuffle joins are split by AQE even when that adds an exchange later
# in the plan: one key may hold a large share of a fact table.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable options on an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def small_partitions(spark: SparkSession) -> SparkSession:
    """A session over the same context with the settings of ``spark``, except that shuffles are read in partitions of 8 MB at most.

    For sorts and aggregations that keep every row of a task in memory. The given session stays as it is; a smaller size or more
    partitions set there hold here, too. Up to 200 partitions a map task writes without sorting its rows."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own.conf.set(size, min(8 << 20, _bytes(spark.conf.get(size))))
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own.conf.set(first, max(200, int(spark.conf.get(first, spark.conf.get("spark.sql.shuffle.partitions")))))
    return own


def _bytes(size: str) -> int:
    """Spark's text of a size (``64MB``, ``8m``, ``1048576b``) as a number of bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << (10 * "bkmgtp".index((unit or "b")[0]))


def local_session(cores: int | str = "*", app: str = "matchday", shuffle_partitions: int = 8,
                  **extra: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RUNTIME_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
