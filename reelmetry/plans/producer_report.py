"""Per-producer statistics and the four report tables.

These read the raw samples in file order (``seq``): no duplicate averaging, no
filling, no timestamp parsing. A metric without rows counts as 0; a metric with
rows but no value gives null.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.functions.text import pad_right, two_decimals
from reelmetry.functions.times import report_stamp
from reelmetry.operators.ordered import TARGET_ROWS
from reelmetry.operators.quantiles import exact_quantile
from reelmetry.operators.series import first_difference, telescoped_mean_difference

# --- fixed values: layout of the text report (heading, width, statistic) ---
REPORT_TITLE = "Performance Analysis Results - "
REPORT_RULE = "=" * 50
_CPU = ("CPU Usage (%)", 15, "cpu_usage")
_MEMORY = ("Memory usage (MB)", 15, "memory_usage")
REPORT_TABLES = [
    ("Table X - Real-Time Video Processing Metrics by Producer", [
        ("Frame Production Rate (fps)", 25, "frame_production_rate"),
        ("Frames Produced (total)", 20, "frames_produced_total"),
        ("Avg Latency (ms)", 15, "avg_latency"),
        ("Consumer Lag (ms)", 15, "consumer_lag"),
        ("Message Consumpt. Time (ms)", 25, "message_consumption_time"),
        ("Messages Consumed (total)", 20, "messages_consumed_total"),
    ]),
    ("Table X - Resource Utilization by Producer", [
        _CPU,
        ("Memory Usage (MB)", 15, "memory_usage"),
        ("Disk Read/Write (MB/s)", 20, "disk_read_write"),
        ("Network I/O (MB/s)", 15, "network_io"),
    ]),
    ("Table X - Throughput by Producer", [
        ("Avg. Throughput (fps)", 20, "avg_throughput"),
        ("Peak Throughput (fps)", 20, "peak_throughput"),
        _CPU, _MEMORY,
    ]),
    ("Table X - Latency by Producer", [
        ("Avg. Latency (ms)", 20, "avg_latency"),
        ("P99 Latency (ms)", 20, "p99_latency"),
        _CPU, _MEMORY,
    ]),
]
PRODUCER_WIDTH = 15


def _is(metric: str) -> Column:
    return F.col("metric") == metric


def _or_zero(value: str, *metrics: str) -> str:
    """``value``, or 0 when one of the metrics has no row for the producer."""
    absent = " OR ".join(f"count_if(metric = '{m}') = 0" for m in metrics)
    return f"CASE WHEN {absent} THEN 0.0D ELSE {value} END"


def _mean(metric: str) -> str:
    return f"avg(value) FILTER (WHERE metric = '{metric}')"


def _last(metric: str) -> str:
    return _or_zero(f"max_by(value, seq) FILTER (WHERE metric = '{metric}')", metric)


def _mean_of_pair(a: str, b: str) -> str:
    return _or_zero(f"({_mean(a)} + {_mean(b)}) / 2", a, b)


#: Statistics that one grouping with map-side combining can give.
GROUPED_STATS = {
    "frame_production_rate": _or_zero(telescoped_mean_difference("value", "seq", "metric = 'Frame_prod'"), "Frame_prod"),
    "frames_produced_total": _last("Frame_prod"),
    "avg_latency": _or_zero(f"{_mean('Avg_latency')} * 1000", "Avg_latency"),
    "consumer_lag": _or_zero(_mean("Cons_lag"), "Cons_lag"),
    "message_consumption_time": _or_zero(f"{_mean('Msg_cons_time')} * 1000", "Msg_cons_time"),
    "messages_consumed_total": _last("Msg_cons"),
    "cpu_usage": _or_zero(_mean("CPU"), "CPU"),
    "memory_usage": _or_zero(_mean("Memory"), "Memory"),
    "disk_read_write": _mean_of_pair("Disk_read", "Disk_write"),
    "network_io": _mean_of_pair("Network_received", "Network_sent"),
    "avg_throughput": _or_zero(_mean("Throughput"), "Throughput"),
    "peak_throughput": _or_zero("max(value) FILTER (WHERE metric = 'Throughput')", "Throughput"),
}


def _grouped(samples: DataFrame, wanted: list[str]) -> DataFrame:
    return samples.groupBy("producer").agg(*[F.expr(GROUPED_STATS[n]).alias(n) for n in wanted])


def _with_rate_over_gaps(stats: DataFrame, samples: DataFrame, target_rows: int) -> DataFrame:
    """Replace the telescoped rate where null values make it wrong.

    Looking for one null value is a pushed-down scan that reads next to nothing
    when there is none, and then the telescoped rate stands.
    """
    frames = samples.filter(_is("Frame_prod"))
    if frames.filter(F.col("value").isNull()).isEmpty():
        return stats
    exact = first_difference(frames, target_rows).groupBy("producer").agg(
        F.avg("diff").alias("_rate"), F.lit(True).alias("_has_frames")
    )
    rate = F.when(F.col("_has_frames"), F.col("_rate")).otherwise(F.lit(0.0))
    return stats.join(exact, "producer", "left").withColumn("frame_production_rate", rate).drop("_rate", "_has_frames")


def _with_p99(stats: DataFrame, samples: DataFrame, target_rows: int) -> DataFrame:
    latency = samples.filter(_is("Avg_latency"))
    p99 = exact_quantile(latency, ["producer"], "value", 0.99, "_p99", target_rows)
    present = latency.groupBy("producer").agg(F.lit(True).alias("_has_latency"))
    joined = stats.join(present, "producer", "left").join(p99, "producer", "left")
    value = F.when(F.col("_has_latency"), F.col("_p99") * 1000).otherwise(F.lit(0.0))
    return joined.withColumn("p99_latency", value).drop("_p99", "_has_latency")


def performance_overview(samples: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Production rate, totals, mean latency, lag (in seconds) and consumption time."""
    names = [stat for _, _, stat in REPORT_TABLES[0][1]]
    return _with_rate_over_gaps(_grouped(samples, names), samples, target_rows)


def resource_utilization(samples: DataFrame) -> DataFrame:
    return _grouped(samples, [stat for _, _, stat in REPORT_TABLES[1][1]])


def throughput_analysis(samples: DataFrame) -> DataFrame:
    return _grouped(samples, [stat for _, _, stat in REPORT_TABLES[2][1]])


def latency_analysis(samples: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    stats = _grouped(samples, ["avg_latency", "cpu_usage", "memory_usage"])
    return _with_p99(stats, samples, target_rows)


def producer_stats(samples: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """All statistics, one row per producer."""
    stats = _grouped(samples, list(GROUPED_STATS))
    return _with_p99(_with_rate_over_gaps(stats, samples, target_rows), samples, target_rows)


def report_lines(stats: DataFrame, generated: datetime | None = None) -> DataFrame:
    """The text report as rows (section, producer, line); sort by all three.

    Heading rows carry a null producer and sort before the table rows.
    """
    generated = generated or datetime.now()
    rows, heads = [], [(0, 0, None), (0, 1, REPORT_RULE), (0, 2, "")]
    for number, (title, columns) in enumerate(REPORT_TABLES, start=1):
        names = [pad_right(F.lit("Producer"), PRODUCER_WIDTH), *[pad_right(F.lit(h), w) for h, w, _ in columns]]
        if number > 1:
            heads.append((number, 0, ""))
        heads += [(number, 1, title), (number, 2, F.concat_ws(" ", *names))]
        cells = [pad_right(F.col("producer"), PRODUCER_WIDTH)]
        cells += [pad_right(two_decimals(F.col(stat)), width) for _, width, stat in columns]
        rows.append(F.struct(F.lit(number).alias("section"), F.lit(3).alias("part"),
                             F.concat_ws(" ", *cells).alias("line")))
    heads[0] = (0, 0, F.concat(F.lit(REPORT_TITLE), report_stamp(F.lit(generated))))
    head_rows = [F.struct(F.lit(s).alias("section"), F.lit(p).alias("part"),
                          (line if isinstance(line, Column) else F.lit(line)).alias("line"))
                 for s, p, line in heads]
    spark = stats.sparkSession
    table = stats.select("producer", F.explode(F.array(*rows)).alias("r")).select("r.*", "producer")
    top = spark.range(1).select(F.explode(F.array(*head_rows)).alias("r")).select(
        "r.*", F.lit(None).cast("string").alias("producer")
    )
    return top.unionByName(table)


def ordered_report(stats: DataFrame, generated: datetime | None = None) -> DataFrame:
    """Report lines in print order, ready for a one-file text sink."""
    return report_lines(stats, generated).orderBy("section", "part", "producer").select("line")
