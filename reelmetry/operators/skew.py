"""Size checks, joins with a table of one row per group, stored intermediates."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetry.session import scratch_path

#: Rows a broadcast side may have; at some hundred bytes a row, tens of MB.
BROADCAST_ROWS = 100_000

#: Copies of a group's row when it is not broadcast: a hot group is spread
#: over this many join keys.
SALTS = 64


def rows_within(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; counts no more than one beyond."""
    return df.limit(limit + 1).count() <= limit


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several later steps read: they are computed once, and a
    lost executor costs a re-read, not the whole lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage and return freed memory to the system.

    Plans, broadcasts and the state of finished shuffles are freed only then. The
    driver's heap otherwise grows over the many short jobs of an operator of rounds,
    though little of it is in use. What its compiler and network threads free outside
    the heap, the C library keeps for each of several hundred threads' own use.
    """
    spark.sparkContext._jvm.System.gc()
    trim_native_heap(spark)


def trim_native_heap(spark: SparkSession) -> str:
    """What ``jcmd System.trim_native_heap`` does, in the driver: its report, or nothing where the JVM has no such command."""
    gateway = spark.sparkContext._gateway
    java = gateway.jvm
    # By the interface: the server's own class isn't open to callers.
    call = next(m for m in java.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    given = gateway.new_array(java.java.lang.Object, 4)
    given[0], given[1] = java.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        return call.invoke(java.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JJavaError:  # not Linux with glibc, or an older Java
        return ""


def store_and_release(df: DataFrame, name: str) -> DataFrame:
    """``store`` for operators of many rounds: a stored table ends a round, see ``release``."""
    stored = store(df, name)
    release(df.sparkSession)
    return stored


def few_groups(df: DataFrame, keys: Sequence[str], limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` distinct keys."""
    return rows_within(df.select(*keys).distinct(), limit)


def attach_small(big: DataFrame, small: DataFrame, keys: Sequence[str], *, fits: bool, spread_by: str,
                 salts: int = SALTS) -> DataFrame:
    """Inner join of ``big`` with ``small``, one row per ``keys``.

    ``fits`` is the outcome of a size check of ``small``: then it is broadcast.
    Otherwise the join shuffles on the keys and a salt taken from ``spread_by``,
    so that a group with a third of all rows is spread over ``salts`` tasks.
    """
    keys = list(keys)
    if fits:
        return big.join(F.broadcast(small), keys)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def keep_listed(big: DataFrame, listed: DataFrame, keys: Sequence[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``big`` whose keys are listed (semi-join).

    A list of checked size is broadcast, and the rows stay where they are.
    """
    wanted = listed.select(*keys)
    if rows_within(wanted, limit):
        wanted = F.broadcast(wanted)
    return big.join(wanted, list(keys), "left_semi")
