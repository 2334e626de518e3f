"""Alignment, filling, decomposition and analysis against pandas."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelmetry.operators.correlate import correlation_matrix
from reelmetry.operators.decompose import decompose, decompose_wide, too_short
from reelmetry.operators.series import (
    align, align_by_joins, fill_forward, first_difference, frame_markers, interpolate, mean_duplicates,
    missing_metrics, wide_table,
)
from reelmetry.plans import analysis
from reelmetry.schemas import CORRELATED_METRICS, METRICS

START = datetime(2025, 4, 29, 10)


@pytest.fixture(scope="module")
def samples():
    """Three producers; duplicates, gaps, null values, a row without time."""
    rng = np.random.default_rng(11)
    rows, seq = [], 0
    for producer, steps in (("kafka", 150), ("zio", 90), ("akka", 40)):
        for metric in METRICS:
            if producer == "akka" and metric == "Cons_lag":
                continue
            for step in range(steps):
                if rng.random() < 0.25:
                    continue
                for _ in range(1 + (rng.random() < 0.1)):
                    value = None if rng.random() < 0.03 else float(np.round(rng.gamma(2.0, 30.0), 3))
                    rows.append((producer, metric, START + timedelta(seconds=2 * step), value, seq))
                    seq += 1
    rows.append(("kafka", "CPU", None, 1e9, seq))
    return pd.DataFrame(rows, columns=["producer", "metric", "ts", "value", "seq"])


@pytest.fixture(scope="module")
def df(spark, samples):
    data = [
        (r.producer, r.metric, None if pd.isna(r.ts) else r.ts.to_pydatetime(),
         None if pd.isna(r.value) else float(r.value), int(r.seq)) for r in samples.itertuples()
    ]
    schema = "producer string, metric string, ts timestamp_ntz, value double, seq long"
    return spark.createDataFrame(data, schema).repartition(3).cache()


def pandas_wide(samples, producer, metrics=METRICS):
    timed = samples[(samples.producer == producer) & samples.ts.notna()]
    parts = [timed[timed.metric == m].groupby("ts")["value"].mean().rename(m) for m in metrics]
    return pd.concat(parts, axis=1).sort_index()


def by_producer(got, producer, metrics=METRICS):
    return got[got.producer == producer].sort_values("ts").set_index("ts")[list(metrics)]


def close(a, b):
    np.testing.assert_allclose(a.to_numpy(dtype=float), b.to_numpy(dtype=float), atol=1e-9)


def test_align_equals_outer_joins(samples, df):
    got, chained = align(df).toPandas(), align_by_joins(df).toPandas()
    for producer in ("kafka", "zio", "akka"):
        expected = pandas_wide(samples, producer)
        close(by_producer(got, producer), expected)
        close(by_producer(chained, producer), expected)


@pytest.mark.parametrize("target", [100_000, 60])
def test_fill_and_wide(samples, df, target):
    filled, wide = fill_forward(df, target_rows=target).toPandas(), wide_table(df, target_rows=target).toPandas()
    for producer in ("kafka", "zio", "akka"):
        expected = pandas_wide(samples, producer).ffill()
        close(by_producer(filled, producer), expected)
        close(by_producer(wide, producer), expected.interpolate().fillna(0))


@pytest.mark.parametrize("target", [100_000, 30])
def test_interpolate(samples, df, target):
    got = interpolate(df, "CPU", target).toPandas()
    for producer in ("kafka", "zio", "akka"):
        rows = pandas_wide(samples, producer)["CPU"].interpolate()
        mine = got[got.producer == producer].sort_values("ts")
        close(mine["interpolated"], rows)
        assert mine["pos"].tolist() == list(range(len(rows)))


def test_first_difference_in_file_order(samples, df):
    got = first_difference(df, 200).toPandas().sort_values("seq")
    expected = samples.sort_values("seq").groupby(["producer", "metric"])["value"].diff()
    close(got["diff"], expected)


def test_mean_duplicates_and_missing(samples, df):
    assert mean_duplicates(df).count() == len(samples[samples.ts.notna()].groupby(["producer", "metric", "ts"]))
    missing = {r.producer: r.missing_metrics for r in missing_metrics(df).collect()}
    assert missing == {"kafka": [], "zio": [], "akka": ["Cons_lag"]}


def test_frame_markers(df):
    rows = df.filter("metric = 'CPU' and producer = 'kafka'")
    total = rows.count()
    assert [r.nth for r in frame_markers(rows, 20).orderBy("nth").collect()] == list(range(20, total + 1, 20))


@pytest.mark.parametrize("target", [100_000, 45])
def test_decompose(samples, df, target):
    got = decompose(df, "Throughput", 30, target).toPandas()
    assert set(got.producer) == {"kafka", "zio"}
    again = decompose_wide(wide_table(df), "Throughput", 30, target).toPandas()
    keys = ["producer", "pos"]
    pd.testing.assert_frame_equal(got.sort_values(keys, ignore_index=True), again.sort_values(keys, ignore_index=True))
    for producer in ("kafka", "zio"):
        x = pandas_wide(samples, producer).ffill().fillna(0)["Throughput"].to_numpy()
        weights = np.r_[0.5, np.ones(29), 0.5] / 30
        trend = np.full(len(x), np.nan)
        trend[15:-15] = np.convolve(x, weights, mode="valid")
        means = np.array([np.nanmean((x - trend)[k::30]) for k in range(30)])
        seasonal = np.tile(means - means.mean(), len(x) // 30 + 1)[: len(x)]
        mine = got[got.producer == producer].sort_values("pos")
        for name, expected in (("observed", x), ("trend", trend), ("seasonal", seasonal), ("resid", x - trend - seasonal)):
            np.testing.assert_allclose(mine[name].to_numpy(dtype=float), expected, atol=1e-9)
    short = too_short(df, 30).collect()
    assert [r.producer for r in short] == ["akka"] and short[0]["rows"] < 60


def test_anomalies(df):
    got = analysis.flag_anomalies(df).toPandas()
    for _, rows in got.groupby("producer"):
        limit = 3 * rows.resid.std(ddof=0)
        assert (rows.anomaly == (rows.resid.abs() > limit)).all()


def test_correlation(samples, df):
    got = correlation_matrix(wide_table(df)).toPandas()
    for producer in ("kafka", "zio", "akka"):
        expected = pandas_wide(samples, producer).ffill().fillna(0)[CORRELATED_METRICS].corr()
        mine = got[got.producer == producer].pivot(index="metric_a", columns="metric_b", values="r")
        close(mine.loc[CORRELATED_METRICS, CORRELATED_METRICS], expected)


def test_correlation_of_a_constant_is_null(spark):
    wide = spark.range(5).select(F.lit("p").alias("producer"), F.col("id").cast("double").alias("a"), F.lit(2.0).alias("b"))
    got = {(r.metric_a, r.metric_b): r.r for r in correlation_matrix(wide, ["a", "b"]).collect()}
    assert got[("a", "a")] == 1.0 and got[("b", "b")] is None and got[("a", "b")] is None


@pytest.mark.parametrize("target", [100_000, 50])
def test_bottlenecks_and_efficiency(samples, df, target):
    got = analysis.analysis_summary(df, target).toPandas().set_index("producer")
    for producer in ("kafka", "zio", "akka"):
        wide = pandas_wide(samples, producer).reindex(columns=METRICS).ffill().fillna(0)
        row = got.loc[producer]
        expected = []
        if (wide.CPU > 90).any():
            expected.append("High CPU (>90%)")
        if (wide.Memory > wide.Memory.quantile(0.9)).any():
            expected.append("High Memory (top 10%)")
        assert list(row.bottlenecks) == expected
        assert row.heading == "ANALYZING: " + producer.upper()
        assert abs(row.memory_q90 - wide.Memory.quantile(0.9)) < 1e-9
        assert abs(row.avg_cpu_efficiency - (wide.Frame_prod / (wide.CPU + 0.01)).mean()) < 1e-6
        assert abs(row.avg_mem_efficiency - (wide.Frame_prod / (wide.Memory + 0.01)).mean()) < 1e-6


def test_no_bottleneck_for_a_flat_producer(spark):
    wide = spark.range(10).select(F.lit("p").alias("producer"), F.lit(5.0).alias("CPU"), F.lit(7.0).alias("Memory"))
    row = analysis.bottlenecks(wide).first()
    assert row.bottlenecks == [] and row.memory_q90 == 7.0


def test_full_report_tables(df):
    tables = analysis.full_report(df, target_rows=500)
    assert set(tables) == {"correlations", "decomposition", "bottlenecks", "efficiency", "missing_metrics"}
    assert tables["correlations"].count() == 3 * 64
    assert tables["efficiency"].count() == 3
