"""Running totals of a stream as a table: each micro-batch adds its own small summary to the totals before it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetry.operators.counters import LABELS
from reelmetry.schemas import DEFAULT_BUCKETS

#: Totals of the newest batches that stay: the last one, and the one a replay of it starts from.
KEPT = 2


def bucket_names(bounds: Sequence[float]) -> list[str]:
    return [*[str(float(b)) for b in bounds], "+Inf"]


def consumption_summary(messages: DataFrame, seconds: str, failed: Column, latest: Sequence[str] = (), order: str = "timestamp",
                        bounds: Sequence[float] = DEFAULT_BUCKETS, labels: Sequence[str] = tuple(LABELS)) -> DataFrame:
    """A batch's messages in one row per label set, such that summaries add up.

    ``messages``, ``failures``, ``bytes`` (of ``value``); ``observed`` and ``sum`` of the
    column ``seconds`` and its ``buckets``, not cumulative, one count per bound and one
    above all; ``newest``: time and value of the columns ``latest`` at the highest ``order``.
    """
    value = F.col(seconds)
    bins = [(value <= b) & (value > a if a is not None else F.lit(True)) for a, b in zip([None, *bounds[:-1]], bounds, strict=True)]
    counts = F.array(*[F.count_if(b) for b in bins], F.count_if(value > bounds[-1]))
    newest = F.max(F.struct(F.col(order).alias("at"), *latest)) if latest else F.lit(None).cast("struct<at:timestamp>")
    return messages.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(failed).alias("failures"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("long").alias("bytes"),
        F.count(value).alias("observed"), F.coalesce(F.sum(value), F.lit(0.0)).cast("double").alias("sum"), counts.alias("buckets"), newest.alias("newest"),
    )


def added_up(summaries: DataFrame, labels: Sequence[str] = tuple(LABELS)) -> DataFrame:
    """Summaries of several batches as one, a row per label set."""
    size = F.max(F.size("buckets"))
    grouped = summaries.groupBy(*labels).agg(
        *[F.sum(c).alias(c) for c in ("messages", "failures", "bytes", "observed", "sum")], F.collect_list("buckets").alias("_of"), size.alias("_size"), F.max("newest").alias("newest"))
    total = F.transform(
        F.sequence(F.lit(0), F.col("_size") - 1), lambda i: F.aggregate("_of", F.lit(0).cast("long"), lambda acc, b: acc + F.get(b, i)))
    return grouped.withColumn("buckets", total).select(*labels, "messages", "failures", "bytes", "observed", "sum", "buckets", "newest")


def histogram_rows(totals: DataFrame, bounds: Sequence[float] = DEFAULT_BUCKETS, labels: Sequence[str] = tuple(LABELS)) -> DataFrame:
    """Cumulative buckets (``<= le``) of added-up summaries, one row per label set and bucket."""
    names = F.array(*[F.lit(n) for n in bucket_names(bounds)])
    upto = F.transform("buckets", lambda _, i: F.aggregate(F.slice("buckets", 1, i + 1), F.lit(0).cast("long"), lambda acc, b: acc + b))
    entries = F.arrays_zip(names.alias("le"), upto.alias("bucket"))
    return totals.select(*labels, F.explode(entries).alias("e"), "observed", "sum", "messages", "failures").select(
        *labels, "e.le", "e.bucket", F.col("observed").alias("count"), "sum", "messages", "failures")


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose totals are complete."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath() for s in files.listStatus(folder) if s.isDirectory() and s.getPath().getName().startswith("batch_id=")]
    return sorted(int(p.getName().split("=")[1]) for p in names if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def add_to_totals(path: str, summary: Callable[[DataFrame], DataFrame], labels: Sequence[str] = tuple(LABELS)) -> Callable[[DataFrame, int], None]:
    """Batch function: the totals after batch N are those after the batch before it and N's summary, under N's number.

    A replay of N starts from the same totals and puts its own in place, so nothing
    counts twice. Readers take the newest complete folder, which is never written
    to again; older ones than the last two go. Totals have a row per label set.
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in _batches(spark, root) if n < batch_id]
        summaries = summary(batch)
        if earlier:
            summaries = summaries.unionByName(spark.read.schema(summaries.schema).parquet(f"{root}/batch_id={earlier[-1]}"))
        added_up(summaries, labels).coalesce(1).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
        for n in earlier[: -(KEPT - 1)]:
            _remove(spark, f"{root}/batch_id={n}")

    return write


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals after the newest complete batch."""
    root = path.rstrip("/")
    done = _batches(spark, root)
    if not done:
        raise FileNotFoundError(f"no totals in {path}")
    return spark.read.parquet(f"{root}/batch_id={done[-1]}")
