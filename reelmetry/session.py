"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Settings every job of this package relies on. Executors and memory are left
#: to spark-submit.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A raw 256x256x3 frame is 196,608 bytes: 32 of them make a 6 MiB batch, which
    # stays in the processor's cache; 128 and more took a third longer.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "32",
}


#: Shuffle bytes one task should get, and the bounds of the partition count.
SHUFFLE_TASK_BYTES = 256 * 1024 * 1024
FEWEST_PARTITIONS, MOST_PARTITIONS = 200, 200_000


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for an input size; adaptive execution merges small ones.

    The default of 200 would give a task half a terabyte of a 100 TB input.
    """
    wanted = -(-input_bytes // SHUFFLE_TASK_BYTES)
    return min(max(wanted, FEWEST_PARTITIONS), MOST_PARTITIONS)


def spread_count(spark: SparkSession, units: int) -> int:
    """Tasks for so many independent pieces of work whose rows are too small for adaptive execution to keep apart."""
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(1, min(units, most))


def build_session(app_name: str = "reelmetry", master: str | None = None, input_bytes: int | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes))} if input_bytes else {}
    for key, value in {**JOB_CONF, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read, for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; without that setting it is a
    folder in the warehouse, which all executors share as well.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured
    return f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
