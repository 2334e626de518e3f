"""Exact linear-interpolation quantiles per group, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmetry.operators.ordered import CHUNK, TARGET_ROWS, cut


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float,
                   name: str, target_rows: int = TARGET_ROWS, bound: DataFrame | None = None) -> DataFrame:
    """One row per group with the ``q`` quantile of the non-null values.

    ``bound`` is a frame that is cheaper to count and has at least the rows of
    ``df``. When it is large, ``df`` is read several times: store it before.

    Few rows: the built-in ``percentile``, whose state holds every distinct
    value of a group. More rows: cut the value axis into chunks, count rows
    per (group, chunk) with map-side combining, find the chunk that holds the
    wanted rank, and rank only the distinct values in that chunk.
    """
    keys = list(keys)
    values = df.select(*keys, value).filter(F.col(value).isNotNull())
    few = bound is not None and bound.count() <= target_rows
    series = None if few else cut(values, keys, value, target_rows)
    if few or series.single:
        return values.groupBy(*keys).agg(F.percentile(value, q).alias(name))

    along = Window.partitionBy(*keys).orderBy(CHUNK)
    counts = series.df.groupBy(*keys, CHUNK).agg(F.count("*").alias("_n"))
    ranked = counts.select(
        *keys, CHUNK, "_n",
        (F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        ((F.sum("_n").over(Window.partitionBy(*keys)) - 1) * F.lit(q)).alias("_rank"),
    ).withColumns({"_lo": F.floor("_rank"), "_hi": F.ceil("_rank")})
    wanted = ranked.filter((F.col("_before") <= F.col("_hi")) & (F.col("_before") + F.col("_n") > F.col("_lo")))

    inside = (
        series.df.join(wanted.drop("_n"), [*keys, CHUNK])
        .groupBy(*keys, CHUNK, "_before", "_rank", "_lo", "_hi", value)
        .agg(F.count("*").alias("_n"))
    )
    upto = Window.partitionBy(*keys, CHUNK).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = inside.withColumn("_end", F.col("_before") + F.sum("_n").over(upto))

    def holds(rank: str):
        return (F.col("_end") > F.col(rank)) & (F.col("_end") - F.col("_n") <= F.col(rank))

    low = F.max(F.when(holds("_lo"), F.col(value)))
    high = F.max(F.when(holds("_hi"), F.col(value)))
    fraction = F.first("_rank") - F.first("_lo")
    return placed.groupBy(*keys).agg((low + (high - low) * fraction).alias(name))
