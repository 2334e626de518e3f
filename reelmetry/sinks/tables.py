"""Batch sinks. All overwrite their target as a whole."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from reelmetry.plans.producer_report import ordered_report


def write_parquet(df: DataFrame, path: str) -> int:
    """Write and return the row count, which the written footers hold.

    No second run of the job, and no ``Observation``: once a session has used
    one, MLlib's label indexer can no longer ship its tasks (Spark 4.1).
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_image_list(parsed: DataFrame, path: str) -> None:
    """The (image_path, label) rows of a parsed list; malformed lines stay out."""
    write_csv(parsed.filter("corrupt is null").select("image_path", "label"), path)


def write_report(stats: DataFrame, path: str, generated: datetime | None = None) -> None:
    """The text report as one file; it has a few lines per producer."""
    ordered_report(stats, generated).coalesce(1).write.mode("overwrite").text(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
