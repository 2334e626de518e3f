"""Counters, gauges, histograms, scrapes."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from reelmetry.functions.times import lag_seconds, millis, seconds_from_nanos
from reelmetry.operators import counters as C

START = datetime(2025, 1, 1)
LABELS = ["job"]


def timed(spark, rows):
    data = [(j, START + timedelta(seconds=s), v) for j, s, v in rows]
    return spark.createDataFrame(data, "job string, ts timestamp_ntz, value double").repartition(3)


def test_histogram_is_cumulative(spark):
    values = [0.005, 0.01, 0.0100001, 0.05, 0.3, 1.0, 7.0, None]
    got = C.histogram(timed(spark, [("a", i, v) for i, v in enumerate(values)]), "value", [0.01, 0.05, 0.1, 0.5, 1.0], LABELS)
    rows = {r.le: r for r in got.collect()}
    assert [rows[k].bucket for k in ("0.01", "0.05", "0.1", "0.5", "1.0", "+Inf")] == [2, 4, 4, 5, 6, 7]
    assert rows["+Inf"]["count"] == 7 and abs(rows["+Inf"]["sum"] - sum(v for v in values if v)) < 1e-12


def test_counters_and_gauges(spark):
    df = timed(spark, [("a", 1, 1.0), ("a", 5, 2.0), ("a", 3, 9.0), ("b", 2, 4.0)])
    got = {r.job: (r.big, r.all) for r in C.counters(df, {"big": F.col("value") > 1.5, "all": F.lit(True)}, LABELS).collect()}
    assert got == {"a": (2, 3), "b": (1, 1)}
    assert {r.job: r.value for r in C.gauges(df, ["value"], "ts", LABELS).collect()} == {"a": 2.0, "b": 4.0}


def test_failed_messages_were_consumed(spark):
    df = timed(spark, [("a", 1, 1.0), ("a", 2, -1.0)])
    row = C.consumer_counters(df, F.col("value") < 0, LABELS).first()
    assert (row.messages_consumed_total, row.message_consumption_errors_total) == (2, 1)


def test_producer_outcomes(spark):
    df = spark.createDataFrame([("a", o) for o in ("ok", "ok", "sink_error", "frame_error", "read_error")], "job string, outcome string")
    row = C.producer_counters(df, LABELS).first()
    assert tuple(row)[1:] == (3, 1, 1, 1)


def test_scrape_and_grid(spark):
    df = timed(spark, [("a", 0.5, 1.0), ("a", 1.5, 2.0), ("a", 9.0, 3.0), ("b", 4.0, 5.0)])
    scraped = C.scrape(df, "ts", "value", "2 seconds", LABELS)
    seconds = lambda ts: (ts - START).total_seconds()
    assert sorted((r.job, seconds(r.ts), r.value) for r in scraped.collect()) == [("a", 2, 2.0), ("a", 10, 3.0), ("b", 6, 5.0)]
    grid = C.scrape_grid(scraped, 2, LABELS, target_rows=2, block=3)
    assert sorted((r.job, seconds(r.ts), r.value) for r in grid.collect()) == [
        ("a", 2, 2.0), ("a", 4, 2.0), ("a", 6, 2.0), ("a", 8, 2.0), ("a", 10, 3.0), ("b", 6, 5.0)]


def test_scrape_counter(spark):
    rng = np.random.default_rng(0)
    rows = [(j, float(s), 1.0) for j in "ab" for s in np.sort(rng.uniform(0, 100, 80))]
    got = C.scrape_counter(timed(spark, rows), "ts", 2, LABELS, target_rows=7).toPandas()
    for job, mine in got.groupby("job"):
        ticks = pd.Series([int(s // 2) for j, s, _ in rows if j == job]).value_counts().sort_index()
        assert mine.sort_values("ts")["value"].tolist() == ticks.cumsum().tolist()


def test_lag(spark):
    row = spark.range(1).select(
        lag_seconds(F.lit("2025-01-01 00:00:00.250").cast("timestamp"), F.lit("2025-01-01 00:00:02").cast("timestamp")),
        lag_seconds(F.lit("1969-12-31 23:59:59").cast("timestamp"), F.lit("2025-01-01").cast("timestamp")),
        lag_seconds(F.lit(None).cast("timestamp"), F.lit("2025-01-01").cast("timestamp")),
        seconds_from_nanos(F.lit(2_500_000_000)), millis(F.lit(0.25)),
    ).first()
    assert list(row) == [1.75, 0.0, 0.0, 2.5, 250.0]


def test_scrape_labels(spark):
    df = spark.createDataFrame([("kafka-client:9080",), ("plain",)], "address string")
    got = [tuple(r)[1:] for r in C.with_scrape_labels(df).orderBy("address").collect()]
    assert got == [("kafka-client", "kafka-client:9080", "kafka-client"), (None, "plain", None)]
