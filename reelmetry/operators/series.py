"""Metric time series: duplicate averaging, alignment, filling, differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmetry.operators.ordered import (
    TARGET_ROWS, OrderedSeries, centred_mean, cut, last_known, next_known, number_in_order, position, previous,
)
from reelmetry.operators.skew import rows_within
from reelmetry.schemas import METRICS

SERIES = ["producer", "metric"]


def mean_duplicates(samples: DataFrame) -> DataFrame:
    """One row per (producer, metric, ts): the mean; rows without ts drop out."""
    return (
        samples.filter(F.col("ts").isNotNull())
        .groupBy(*SERIES, "ts")
        .agg(F.avg("value").alias("value"))
    )


def align(samples: DataFrame, metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """Full outer alignment on the timestamp: one row per (producer, ts).

    One conditional mean per metric in a single grouping does duplicate
    averaging and the outer join of all series in one shuffle. Every timestamp
    of any metric gives a row, also when ``metrics`` asks for fewer columns.
    """
    return (
        samples.filter(F.col("ts").isNotNull())
        .groupBy("producer", "ts")
        .agg(*[F.expr(f"avg(value) FILTER (WHERE metric = '{m}')").alias(m) for m in metrics])
    )


def align_by_joins(samples: DataFrame, metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """The same alignment as a chain of full outer joins; kept as a cross-check."""
    means = mean_duplicates(samples)
    wide = None
    for m in metrics:
        one = means.filter(F.col("metric") == m).select("producer", "ts", F.col("value").alias(m))
        wide = one if wide is None else wide.join(one, ["producer", "ts"], "full_outer")
    return wide


def _cut_aligned(samples: DataFrame, metrics: Sequence[str], target_rows: int) -> OrderedSeries:
    timed = samples.filter(F.col("ts").isNotNull())
    return cut(align(timed, metrics), ["producer"], "ts", target_rows, profile=timed)


def fill_forward(samples: DataFrame, metrics: Sequence[str] = tuple(METRICS),
                 target_rows: int = TARGET_ROWS) -> DataFrame:
    """Aligned table with every gap set to the last known value; leading gaps stay null."""
    return _cut_aligned(samples, metrics, target_rows).run(*[last_known(m, m) for m in metrics]).result()


def wide_table(samples: DataFrame, metrics: Sequence[str] = tuple(METRICS),
               target_rows: int = TARGET_ROWS) -> DataFrame:
    """Aligned, forward filled, leading gaps 0: the table all analyses read."""
    return fill_forward(samples, metrics, target_rows).fillna(0.0, subset=list(metrics))


def missing_metrics(samples: DataFrame, metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """Per producer, the expected metrics that have no usable row."""
    present = samples.filter(F.col("ts").isNotNull()).groupBy("producer").agg(
        *[F.max(F.col("metric") == m).alias(m) for m in metrics]
    )
    absent = F.array_compact(F.array(*[F.when(~F.col(m), F.lit(m)) for m in metrics]))
    return present.select("producer", absent.alias("missing_metrics"))


def interpolate(samples: DataFrame, metric: str, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Linear interpolation of one aligned metric by row position, forward only.

    A trailing gap repeats the last value, a leading gap stays null.
    """
    series = _cut_aligned(samples, [metric], target_rows).run(position("pos"))
    known = F.when(F.col(metric).isNotNull(), F.struct("pos", F.col(metric).alias("v")))
    series = series.run(last_known(known, "_before"), next_known(known, "_after"))
    step = (F.col("_after.v") - F.col("_before.v")) / F.nullif(
        F.col("_after.pos") - F.col("_before.pos"), F.lit(0)
    )
    between = F.col("_before.v") + F.coalesce(step * (F.col("pos") - F.col("_before.pos")), F.lit(0.0))
    return series.result().select("producer", "ts", "pos", metric, between.alias("interpolated"))


def positions(samples: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """0-based file-order position of every raw sample in its series."""
    return cut(samples, SERIES, "seq", target_rows).run(position("pos")).result()


def first_difference(samples: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Raw samples with ``diff``: value minus the previous value in file order."""
    series = cut(samples, SERIES, "seq", target_rows).run(previous("value", "_previous"))
    return series.result().withColumn("diff", F.col("value") - F.col("_previous")).drop("_previous")


def telescoped_mean_difference(value: str, order: str, picked: str) -> str:
    """SQL for the mean first difference of the rows where ``picked``, values never null.

    The differences telescope, so (last - first) / (n - 1) needs no window and
    no shuffle of rows. A single row has no difference: null.
    """
    last, first = (f"{f}({value}, {order}) FILTER (WHERE {picked})" for f in ("max_by", "min_by"))
    return f"try_divide({last} - {first}, count_if({picked}) - 1)"


def trend(wide: OrderedSeries | DataFrame, value: str, period: int = 30, block_rows: int = TARGET_ROWS) -> DataFrame:
    """Centred moving average of a gapless series with 0-based ``pos``."""
    rows = wide.result() if isinstance(wide, OrderedSeries) else wide
    return centred_mean(rows, ["producer"], "pos", value, period, "trend", block_rows)


def frame_markers(samples: DataFrame, every: int = 100, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Every n-th row of a series, counted from 1."""
    counted = positions(samples, target_rows).withColumn("nth", F.col("pos") + 1)
    return counted.filter(F.col("nth") % every == 0)


def ordered_files(files: DataFrame, folder: str = "folder", name: str = "name",
                  target_rows: int = TARGET_ROWS) -> DataFrame:
    """Directory listing with a 0-based sequence by name within each folder."""
    if rows_within(files, target_rows):
        in_folder = Window.partitionBy(folder).orderBy(name)
        return files.filter(F.col(folder).isNotNull()).withColumn("frame_seq", (F.row_number().over(in_folder) - 1).cast("long"))
    return number_in_order(files, [folder], name, "frame_seq")
