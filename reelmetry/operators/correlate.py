"""Pearson correlation matrix per producer."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetry.operators.skew import attach_small, few_groups
from reelmetry.schemas import CORRELATED_METRICS


def correlation_matrix(wide: DataFrame, metrics: Sequence[str] = tuple(CORRELATED_METRICS),
                       bound: DataFrame | None = None) -> DataFrame:
    """(producer, metric_a, metric_b, r) for all ordered pairs of null-free columns.

    Two groupings with map-side combining: first the means, then sums of
    products of the deviations. That keeps the precision, and the many sums
    compile to a third of the run time of as many ``covar_pop``. ``wide`` is
    read twice; ``bound`` is a cheaper frame with the same producers.
    A constant column has no correlation: null.
    """
    metrics = list(metrics)
    centres = wide.groupBy("producer").agg(
        *[F.avg(m).alias(f"_m_{m}") for m in metrics],
        *[F.expr(f"max(`{m}`) > min(`{m}`)").alias(f"_v_{m}") for m in metrics],
    )
    fits = few_groups(wide if bound is None else bound, ["producer"])
    # The time differs from row to row, a metric may be constant.
    times = [c for c in wide.columns if c == "ts"]
    joined = attach_small(wide.select("producer", *times, *metrics), centres, ["producer"], fits=fits, spread_by=(times or metrics)[0])
    deviations = joined.selectExpr(
        "producer", *[f"CASE WHEN `_v_{m}` THEN `{m}` - `_m_{m}` END AS `{m}`" for m in metrics]
    )
    pairs = list(combinations_with_replacement(metrics, 2))
    sums = deviations.groupBy("producer").agg(*[F.expr(f"sum(`{a}` * `{b}`)").alias(f"{a}|{b}") for a, b in pairs])

    rows = []
    for a, b in pairs:
        if a == b:
            rows.append(f"'{a}', '{a}', CASE WHEN `{a}|{a}` > 0 THEN 1.0D END")
        else:
            r = f"try_divide(`{a}|{b}`, sqrt(`{a}|{a}`) * sqrt(`{b}|{b}`))"
            rows += [f"'{a}', '{b}', {r}", f"'{b}', '{a}', {r}"]
    return sums.selectExpr("producer", f"stack({len(rows)}, {', '.join(rows)}) AS (metric_a, metric_b, r)")
