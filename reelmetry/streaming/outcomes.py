"""What became of every row of a job: results, an error table and counts, without a second pass over the input.

A row with a message in its ``error`` column has failed. Counts are of what was
written: stored rows are counted from the files' footers, sent ones by observed
metrics of the write that sends them. Everything of a micro-batch lies under its
number: a replay puts its own results, errors and counts in place again and adds
nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTS = "rows long, failures long"


def write_counts(spark: SparkSession, counts: tuple[int, int], path: str) -> None:
    """A table of one row: ``rows`` and ``failures``."""
    spark.createDataFrame([counts], COUNTS).coalesce(1).write.mode("overwrite").parquet(path)


def write_outcomes(df: DataFrame, path: str, error: str = "error") -> tuple[int, int]:
    """Writes good and bad rows apart (``failed=false``, ``failed=true``) in one write; returns rows and failures."""
    df.withColumn("failed", F.col(error).isNotNull()).write.mode("overwrite").partitionBy("failed").parquet(path)
    spark = df.sparkSession
    stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("failed", T.StringType())])).parquet(path)
    # No column is read: the files' footers have the counts.
    failures = stored.where("failed = 'true'").count()
    return stored.where("failed = 'false'").count() + failures, failures


def keep_outcomes(path: str, send: Callable[[DataFrame], None] | None = None, error: str = "error") -> Callable[[DataFrame, int], None]:
    """Batch function: good and bad rows in one split table, their counts beside it.

    ``send`` gets the good rows as they were stored, so sending them again, after a
    fault, computes nothing again.
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, target = batch.sparkSession, f"{root}/rows/batch_id={batch_id}"
        counts = write_outcomes(batch, target, error)
        if send and counts[0] > counts[1]:
            send(spark.read.schema(batch.schema).parquet(f"{target}/failed=false"))
        write_counts(spark, counts, f"{root}/counts/batch_id={batch_id}")

    return write


def send_outcomes(path: str, send: Callable[[DataFrame], None], about: Sequence[str], error: str = "error") -> Callable[[DataFrame, int], None]:
    """Batch function for payloads too large to store: good rows are sent straight on.

    The write that sends them counts all rows and the failed ones; the observation
    lives in the batch's session, which in a stream is the query's own. Only a batch
    with failures is looked at again, for the columns ``about`` and ``error`` of those rows.
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(error).isNotNull()).alias("failures"))
        send(rows.where(F.col(error).isNull()).drop(error))
        found = seen.get or {}  # a plan that turned out to be empty has nothing observed
        counts = int(found.get("rows") or 0), int(found.get("failures") or 0)
        if counts[1]:
            batch.where(F.col(error).isNotNull()).select(*about, error).write.mode("overwrite").parquet(f"{root}/errors/batch_id={batch_id}")
        write_counts(batch.sparkSession, counts, f"{root}/counts/batch_id={batch_id}")

    return write


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # no batch has written any yet
        return spark.createDataFrame([], schema)


def read_rows(spark: SparkSession, path: str, failed: bool = False) -> DataFrame:
    """The good (or failed) rows that ``keep_outcomes`` stored; the other ones are never opened."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    return rows.where(F.col("failed").cast("boolean") == failed).drop("failed", "batch_id")


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """The failed rows that ``send_outcomes`` noted."""
    return _read(spark, f"{path.rstrip('/')}/errors", "error string, batch_id int").drop("batch_id")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows and failures of each batch."""
    return _read(spark, f"{path.rstrip('/')}/counts", f"{COUNTS}, batch_id int")
