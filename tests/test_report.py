"""The per-producer statistics and the text report."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from reelmetry.plans import producer_report as report
from reelmetry.schemas import METRICS
from reelmetry.sinks.tables import write_report

SCHEMA = "producer string, metric string, ts timestamp_ntz, value double, seq long"


def make(spark, series):
    """series: {(producer, metric): [values]}; None is a missing value."""
    start = datetime(2025, 1, 1)
    rows = [(p, m, start, v, i) for (p, m), values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def pandas_stats(series, producer):
    get = {m: pd.Series(series.get((producer, m), []), dtype=float) for m in METRICS}

    def or_zero(names, value):
        return 0.0 if any(get[n].empty for n in names) else value(*[get[n] for n in names])

    return {
        "frame_production_rate": or_zero(["Frame_prod"], lambda s: s.diff().mean()),
        "frames_produced_total": or_zero(["Frame_prod"], lambda s: s.iloc[-1]),
        "avg_latency": or_zero(["Avg_latency"], lambda s: s.mean() * 1000),
        "consumer_lag": or_zero(["Cons_lag"], lambda s: s.mean()),
        "message_consumption_time": or_zero(["Msg_cons_time"], lambda s: s.mean() * 1000),
        "messages_consumed_total": or_zero(["Msg_cons"], lambda s: s.iloc[-1]),
        "cpu_usage": or_zero(["CPU"], lambda s: s.mean()),
        "memory_usage": or_zero(["Memory"], lambda s: s.mean()),
        "disk_read_write": or_zero(["Disk_read", "Disk_write"], lambda a, b: (a.mean() + b.mean()) / 2),
        "network_io": or_zero(["Network_received", "Network_sent"], lambda a, b: (a.mean() + b.mean()) / 2),
        "avg_throughput": or_zero(["Throughput"], lambda s: s.mean()),
        "peak_throughput": or_zero(["Throughput"], lambda s: s.max()),
        "p99_latency": or_zero(["Avg_latency"], lambda s: s.quantile(0.99) * 1000),
    }


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(2)
    full = {("kafka", m): [float(v) for v in rng.gamma(2, 20, 60).round(2)] for m in METRICS}
    full[("kafka", "Frame_prod")][10] = None  # a gap inside the counter
    full[("kafka", "Frame_prod")][11] = None
    full[("kafka", "Msg_cons")][-1] = None  # the last value is missing
    sparse = {("zio", "CPU"): [1.0, 2.0], ("zio", "Disk_read"): [5.0], ("zio", "Frame_prod"): [7.0],
              ("zio", "Avg_latency"): [None, None]}
    return {**full, **sparse}


@pytest.mark.parametrize("target", [10_000, 25])
def test_stats_match_pandas(spark, series, target):
    got = report.producer_stats(make(spark, series), target).toPandas().set_index("producer")
    for producer in ("kafka", "zio"):
        for name, value in pandas_stats(series, producer).items():
            mine = got.loc[producer, name]
            assert (pd.isna(mine) and pd.isna(value)) or abs(mine - value) < 1e-9, (producer, name, mine, value)


def test_telescoped_rate_without_gaps(spark, series):
    clean = {k: [v for v in vs if v is not None] or [1.0] for k, vs in series.items()}
    got = report.performance_overview(make(spark, clean)).toPandas().set_index("producer")
    expected = pandas_stats(clean, "kafka")["frame_production_rate"]
    assert abs(got.loc["kafka", "frame_production_rate"] - expected) < 1e-9
    assert pd.isna(got.loc["zio", "frame_production_rate"])  # one sample has no difference


def test_text_report(spark, tmp_path):
    values = {("kafka", m): [0.125, 2.675, 1234567.891] for m in METRICS}
    values[("a-producer-with-a-long-name", "CPU")] = [51.665]
    samples = make(spark, values)
    stats = report.producer_stats(samples)
    write_report(stats, str(tmp_path / "out"), datetime(2025, 4, 29, 15, 8, 30))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    rows = {r["producer"]: r for r in stats.collect()}

    lines = ["Performance Analysis Results - 2025-04-29 15:08:30", "=" * 50, ""]
    for number, (title, columns) in enumerate(report.REPORT_TABLES):
        lines += ([""] if number else []) + [title]
        layout = " ".join(["{:<15}"] + [f"{{:<{w}}}" for _, w, _ in columns])
        lines.append(layout.format("Producer", *[h for h, _, _ in columns]))
        layout = " ".join(["{:<15}"] + [f"{{:<{w}.2f}}" for _, w, _ in columns])
        for name in sorted(rows):
            lines.append(layout.format(name, *[rows[name][s] for _, _, s in columns]))
    assert text == "\n".join(lines) + "\n"
