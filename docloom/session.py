"""Sessions: a local one for tests and scripts, and what any session needs to run this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_HOME = str(Path(__file__).resolve().parent.parent)


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


#: Rows and bytes of an Arrow batch: what a worker holds of its input at a time.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16777216"}
#: Workers give freed memory back instead of keeping it in pools.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576"}


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import this package (a cluster ships it with --py-files), in bounded memory."""
    env = spark.sparkContext.environment
    for key, value in WORKER_ENV.items():
        env.setdefault(key, value)
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if _HOME not in have:
        env["PYTHONPATH"] = os.pathsep.join([_HOME, *filter(None, have)])
    return spark


#: Pieces that a shuffle is dealt into before adaptive execution puts small ones together, so that tasks follow the bytes and not the session's number.
PIECES = 400


def fine_shuffles(spark: SparkSession) -> SparkSession:
    """At least so many pieces, unless the session says how many."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(PIECES, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark
