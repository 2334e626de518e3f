"""Copy a table to CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelmetry.sinks.tables import write_csv
from reelmetry.sources.tables import read_table


def copy_table(source: DataFrame, path: str) -> None:
    """Extract and load of any source table as CSV with a header."""
    write_csv(source, path)


def copy_database_table(spark: SparkSession, url: str, table: str, path: str, **read_options) -> None:
    copy_table(read_table(spark, url, table, **read_options), path)
