"""Labelled lists, label index, reproducible samples and splits, F1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.functions.text import join_path, tokens


def parse_image_list(lines: DataFrame, base_path: str, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``path label`` lines to (image_path, label); other lines land in ``corrupt``."""
    words = lines.withColumn("_t", tokens(F.col(line)))
    fits = F.size("_t") == 2
    return words.select(
        *keep,
        F.when(fits, join_path(base_path, F.get("_t", F.lit(0)))).alias("image_path"),
        F.when(fits, F.get("_t", F.lit(1))).alias("label"),
        F.when(~fits, F.col(line)).alias("corrupt"),
    )


def union_lists(*lists: DataFrame) -> DataFrame:
    """All rows of all lists, duplicates kept."""
    first, *rest = lists
    for other in rest:
        first = first.unionByName(other)
    return first


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """Bucket of a key from its md5: the same in every run, partitioning and engine."""
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def down_sample(df: DataFrame, key: str, fraction: float = 0.01) -> DataFrame:
    return df.filter(hash_bucket(F.col(key), 10_000, "sample") < round(fraction * 10_000))


def with_split(df: DataFrame, key: str, train_fraction: float = 0.8) -> DataFrame:
    """Rows with ``split``: train or test."""
    train = hash_bucket(F.col(key), 10_000, "split") < round(train_fraction * 10_000)
    return df.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("test")))


def with_fold(df: DataFrame, key: str, folds: int = 3) -> DataFrame:
    return df.withColumn("fold", hash_bucket(F.col(key), folds, "fold").cast("int"))


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def weighted_f1(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 per class weighted by support, in one grouping of the predictions.

    Everything after the first grouping works on the confusion table, one row
    per (label, prediction).
    """
    cells = predictions.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("k"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), hit.alias("tp")),
        F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
    )
    classes = cells.select(F.explode(sides).alias("s")).select("s.*").groupBy("k").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    f1 = F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted"))
    return classes.agg(
        F.try_divide(F.sum(F.col("support") * f1), F.sum("support")).alias("f1"),
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("rows"),
    )
