"""Relational and model sources."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
               bounds: tuple[int, int] | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A database table; with a partition column it is read by ``partitions`` tasks."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        if bounds is None or partitions < 1:
            raise ValueError("a partitioned read needs bounds and partitions")
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
