"""Additive seasonal decomposition of one metric per producer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmetry.operators.ordered import TARGET_ROWS, OrderedSeries, centred_mean, cut, last_known, position
from reelmetry.operators.series import align
from reelmetry.operators.skew import BROADCAST_ROWS, attach_small, few_groups, store


def decompose(samples: DataFrame, metric: str = "Throughput", period: int = 30,
              target_rows: int = TARGET_ROWS) -> DataFrame:
    """observed, trend, seasonal and resid per (producer, ts), from raw samples.

    Only the one metric is aligned and filled. Producers with fewer than two
    full periods are left out; see ``too_short``.
    """
    timed = samples.filter(F.col("ts").isNotNull())
    series = cut(align(timed, [metric]), ["producer"], "ts", target_rows, profile=timed)
    return _components(series.run(last_known(metric, metric), position("pos")), metric, period, target_rows, timed)


def decompose_wide(wide: DataFrame, metric: str = "Throughput", period: int = 30,
                   target_rows: int = TARGET_ROWS) -> DataFrame:
    """The same from a stored aligned table, of which it reads three columns."""
    narrow = wide.select("producer", "ts", metric)
    series = cut(narrow, ["producer"], "ts", target_rows)
    return _components(series.run(position("pos")), metric, period, target_rows, narrow)


def _components(placed: OrderedSeries, metric: str, period: int, target_rows: int, producers: DataFrame) -> DataFrame:
    """Split positioned rows into their components.

    The seasonal means are a table of ``period`` rows per producer, built with
    map-side combining and joined back behind a check of the producer count.
    """
    observed = placed.result().select("producer", "ts", "pos", F.coalesce(metric, F.lit(0.0)).alias("observed"))
    trended = centred_mean(observed, ["producer"], "pos", "observed", period, "trend", target_rows)
    trended = trended.withColumn("phase", (F.col("pos") % period).cast("int"))
    if not placed.single:
        trended = store(trended, "trend")  # read twice below

    phases = trended.groupBy("producer", "phase").agg(
        F.avg(F.col("observed") - F.col("trend")).alias("raw"), F.count("*").alias("n")
    )
    of_producer = Window.partitionBy("producer")  # ``period`` rows each
    table = phases.select(
        "producer", "phase", (F.col("raw") - F.avg("raw").over(of_producer)).alias("seasonal"),
        F.sum("n").over(of_producer).alias("rows"),
    ).filter(F.col("rows") >= 2 * period).drop("rows")

    fits = few_groups(producers, ["producer"], BROADCAST_ROWS // period)
    joined = attach_small(trended, table, ["producer", "phase"], fits=fits, spread_by="pos")
    return joined.select(
        "producer", "ts", "pos", "observed", "trend", "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )


def too_short(samples: DataFrame, period: int = 30) -> DataFrame:
    """Producers that cannot be decomposed, with their row count."""
    rows = samples.filter(F.col("ts").isNotNull()).groupBy("producer", "ts").agg(F.lit(1).alias("one"))
    return rows.groupBy("producer").agg(F.count("*").alias("rows")).filter(F.col("rows") < 2 * period)
