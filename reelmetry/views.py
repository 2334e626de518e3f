"""Views that give the driver's tables the shape of the package's inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetry.schemas import METRICS

PRODUCERS = ["kafka", "akka", "cats", "fs2", "zio"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    """values[index], for a non-negative index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def producer_of(user_id: Column) -> Column:
    return _pick(PRODUCERS, user_id % len(PRODUCERS))


def metric_samples_from_events(events: DataFrame, producer: Column | None = None) -> DataFrame:
    """Long metric table: producer, metric, ts, value and file order ``seq``."""
    return events.select(
        (producer_of(F.col("user_id")) if producer is None else producer).alias("producer"),
        _pick(METRICS, F.col("event_id") % len(METRICS)).alias("metric"),
        F.col("ts"),
        F.col("value"),
        F.col("event_id").alias("seq"),
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_samples_from_events(table(spark, sf_dir, "events"))


def hourly_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples on a whole-hour clock, so that series share timestamps."""
    return metric_samples(spark, sf_dir).withColumn(
        "ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    """Consumed messages with scrape labels, record time, size and work time."""
    worker = F.col("user_id") % len(PRODUCERS)
    return events.select(
        F.concat(F.lit("client"), worker, F.lit(":"), worker + 9080).alias("address"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("event_type"),
        F.encode("props", "UTF-8").alias("value"),
        (F.col("value") / 500).alias("seconds"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(table(spark, sf_dir, "events"))


def frames_from_embeddings(embeddings: DataFrame, color: bool = False) -> DataFrame:
    """Each 64-float embedding as an 8x8 frame, gray or BGR.

    A value v is the gray level; in color it becomes (v, 255 - v, 7 v mod 256).
    """
    level = F.transform(
        "embedding",
        lambda e: F.least(
            F.lit(255), F.greatest(F.lit(0), F.floor((e.cast("double") + 1) * 127.5).cast("int"))
        ),
    )
    def text(v: Column) -> Column:
        return F.lpad(F.hex(v), 2, "0")

    def bgr(v: Column) -> Column:
        return F.concat(text(v), text(255 - v), text(v * 7 % 256))

    hex_text = F.array_join(F.transform(level, bgr if color else text), "")
    return embeddings.select("vec_id", "label", F.unhex(hex_text).alias("data"))


def frames8(spark: SparkSession, sf_dir: str, color: bool = False) -> DataFrame:
    return frames_from_embeddings(table(spark, sf_dir, "embeddings"), color)


def image_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines ``path<TAB>label`` of a labelled image list."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", F.format_string("  img/%d.jpg\t%d ", "doc_id", "quality").alias("value")
    )
