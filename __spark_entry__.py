"""

Every query reads whole tables of the given folder. Queries that need another
input shape read the views of ``reelmetry.views``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from reelmetry import views as V  # noqa: E402
from reelmetry.functions import text as X  # noqa: E402
from reelmetry.functions.pixels import gray_frame, resize_frame, signed_values  # noqa: E402
from reelmetry.operators import counters as C  # noqa: E402
from reelmetry.operators import frames as FR  # noqa: E402
from reelmetry.operators import labels as L  # noqa: E402
from reelmetry.operators import series as S  # noqa: E402
from reelmetry.operators.correlate import correlation_matrix  # noqa: E402
from reelmetry.operators.decompose import decompose, too_short  # noqa: E402
from reelmetry.operators.ordered import cut, position  # noqa: E402
from reelmetry.operators.quantiles import exact_quantile  # noqa: E402
from reelmetry.plans import analysis as A  # noqa: E402
from reelmetry.plans import inference as IF  # noqa: E402
from reelmetry.plans import ingest as IN  # noqa: E402
from reelmetry.plans import producer_report as R  # noqa: E402
from reelmetry.plans import training as TR  # noqa: E402
from reelmetry.plans.etl import copy_table  # noqa: E402
from reelmetry.schemas import (  # noqa: E402
    CORRELATED_METRICS, DEFAULT_BUCKETS, FRAME_TIME_BUCKETS, METRIC_DISPLAY_NAMES, METRICS, FrameShape,
)
from reelmetry.session import scratch_path  # noqa: E402
from reelmetry.sinks import tables as K  # noqa: E402
from reelmetry.sources import files as SF  # noqa: E402
from reelmetry.sources import kafka as KF  # noqa: E402
from reelmetry.streaming import jobs as J  # noqa: E402
from reelmetry.streaming import outcomes as OC  # noqa: E402
from reelmetry.streaming import ticks as TK  # noqa: E402
from reelmetry.streaming import totals as TT  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return keep


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# --------------------------------------------------------------------------
# Inputs in SQL
# --------------------------------------------------------------------------

def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SAMPLES = f"""samples AS (
  SELECT ({_sql_list(V.PRODUCERS)})[user_id % 5 + 1] AS producer,
         ({_sql_list(METRICS)})[event_id % 12 + 1] AS metric,
         ts, value, event_id AS seq
  FROM events)"""
HOURLY = f"""{SAMPLES}, hourly AS (
  SELECT producer, metric, date_trunc('hour', ts)::TIMESTAMP AS ts, value, seq FROM samples)"""
ALIGNED = HOURLY + ", aligned AS (SELECT producer, ts, " + ", ".join(
    f"avg(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in METRICS
) + " FROM hourly GROUP BY producer, ts)"
FILLED = ALIGNED + ", filled AS (SELECT producer, ts, " + ", ".join(
    f"last_value({m} IGNORE NULLS) OVER w AS {m}" for m in METRICS
) + " FROM aligned WINDOW w AS (PARTITION BY producer ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
WIDE = FILLED + ", wide AS (SELECT producer, ts, " + ", ".join(
    f"coalesce({m}, 0.0) AS {m}" for m in METRICS
) + " FROM filled)"
MESSAGES = """messages AS (
  SELECT 'client' || (user_id % 5) || ':' || (9080 + user_id % 5) AS address, event_id AS "offset",
         ts AS "timestamp", event_type, props, value / 500 AS seconds,
         'client' || (user_id % 5) AS application,
         'client' || (user_id % 5) || ':' || (9080 + user_id % 5) AS instance,
         'client' || (user_id % 5) AS job
  FROM events)"""
PIXELS = """pixels AS (
  SELECT vec_id, label, list_transform(embedding, lambda e:
    least(255, greatest(0, floor((e::DOUBLE + 1) * 127.5)::INT))) AS px FROM embeddings)"""


def _rounds(names, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{n}, 6) AS {n}" for n in names)


# --------------------------------------------------------------------------
# Per-producer report
# --------------------------------------------------------------------------

def _avg(m: str) -> str:
    return f"avg(value) FILTER (metric = '{m}')"


def _zero(expr: str, *metrics: str) -> str:
    none = " OR ".join(f"count(*) FILTER (metric = '{m}') = 0" for m in metrics)
    return f"CASE WHEN {none} THEN 0.0 ELSE {expr} END"


def _pair(a: str, b: str) -> str:
    return _zero(f"({_avg(a)} + {_avg(b)}) / 2", a, b)


STAT_SQL = {
    "frame_production_rate": _zero("avg(diff) FILTER (metric = 'Frame_prod')", "Frame_prod"),
    "frames_produced_total": _zero("arg_max(value, seq) FILTER (metric = 'Frame_prod')", "Frame_prod"),
    "avg_latency": _zero(_avg("Avg_latency") + " * 1000", "Avg_latency"),
    "consumer_lag": _zero(_avg("Cons_lag"), "Cons_lag"),
    "message_consumption_time": _zero(_avg("Msg_cons_time") + " * 1000", "Msg_cons_time"),
    "messages_consumed_total": _zero("arg_max(value, seq) FILTER (metric = 'Msg_cons')", "Msg_cons"),
    "cpu_usage": _zero(_avg("CPU"), "CPU"),
    "memory_usage": _zero(_avg("Memory"), "Memory"),
    "disk_read_write": _pair("Disk_read", "Disk_write"),
    "network_io": _pair("Network_received", "Network_sent"),
    "avg_throughput": _zero(_avg("Throughput"), "Throughput"),
    "peak_throughput": _zero("max(value) FILTER (metric = 'Throughput')", "Throughput"),
    "p99_latency": _zero("quantile_cont(value, 0.99) FILTER (metric = 'Avg_latency') * 1000", "Avg_latency"),
}


def _stats_sql(names, samples: str = SAMPLES) -> str:
    columns = ", ".join(f"round({STAT_SQL[n]}, 6) AS {n}" for n in names)
    return f"""WITH {samples}, diffs AS (
      SELECT *, value - lag(value) OVER (PARTITION BY producer, metric ORDER BY seq) AS diff FROM samples)
      SELECT producer, {columns} FROM diffs GROUP BY producer"""


PERFORMANCE = [s for _, _, s in R.REPORT_TABLES[0][1]]
RESOURCE = [s for _, _, s in R.REPORT_TABLES[1][1]]
THROUGHPUT = [s for _, _, s in R.REPORT_TABLES[2][1]]
LATENCY = [s for _, _, s in R.REPORT_TABLES[3][1]]


@register("performance_overview", _stats_sql(PERFORMANCE))
def performance_overview(spark, sf):
    return rounded(R.performance_overview(V.metric_samples(spark, sf)), *PERFORMANCE)


@register("resource_utilization", _stats_sql(RESOURCE))
def resource_utilization(spark, sf):
    return rounded(R.resource_utilization(V.metric_samples(spark, sf)), *RESOURCE)


@register("throughput_analysis", _stats_sql(THROUGHPUT))
def throughput_analysis(spark, sf):
    return rounded(R.throughput_analysis(V.metric_samples(spark, sf)), *THROUGHPUT)


@register("latency_analysis", _stats_sql(LATENCY))
def latency_analysis(spark, sf):
    return rounded(R.latency_analysis(V.metric_samples(spark, sf)), *LATENCY)


@register("producer_statistics", _stats_sql(STAT_SQL))
def producer_statistics(spark, sf):
    return rounded(R.producer_stats(V.metric_samples(spark, sf)), *STAT_SQL)


@register("producer_statistics_chunked", _stats_sql(STAT_SQL))
def producer_statistics_chunked(spark, sf):
    """The same with small chunks: the plan that large inputs get."""
    return rounded(R.producer_stats(V.metric_samples(spark, sf), target_rows=40), *STAT_SQL)


REPORT_TIME = datetime(2025, 4, 29, 15, 8, 30)


def _report_sql() -> str:
    parts = [
        f"SELECT 0 AS section, 0 AS part, NULL AS producer, '{R.REPORT_TITLE}' || "
        f"strftime(TIMESTAMP '{REPORT_TIME}', '%Y-%m-%d %H:%M:%S') AS line",
        f"SELECT 0, 1, NULL, '{R.REPORT_RULE}'", "SELECT 0, 2, NULL, ''",
    ]
    for number, (title, columns) in enumerate(R.REPORT_TABLES, start=1):
        head = " ".join(["Producer".ljust(15), *[h.ljust(w) for h, w, _ in columns]])
        if number > 1:
            parts.append(f"SELECT {number}, 0, NULL, ''")
        parts += [f"SELECT {number}, 1, NULL, '{title}'", f"SELECT {number}, 2, NULL, '{head}'"]
        cells = " || ' ' || ".join(
            [f"printf('%-{R.PRODUCER_WIDTH}s', producer)", *[f"printf('%-{w}s', printf('%.2f', {s}))" for _, w, s in columns]]
        )
        parts.append(f"SELECT {number}, 3, producer, {cells} FROM stats")
    return f"WITH stats AS ({_stats_sql(STAT_SQL)}) " + " UNION ALL ".join(parts)


@register("report_text", _report_sql())
def report_text(spark, sf):
    stats = rounded(R.producer_stats(V.metric_samples(spark, sf)), *STAT_SQL)
    return R.report_lines(stats, REPORT_TIME)


@register("latency_quantiles", f"""WITH {SAMPLES} SELECT producer, metric, round(quantile_cont(value, 0.9), 6) AS q90
  FROM samples GROUP BY producer, metric""")
def latency_quantiles(spark, sf):
    return rounded(exact_quantile(V.metric_samples(spark, sf), S.SERIES, "value", 0.9, "q90", target_rows=40), "q90")


# --------------------------------------------------------------------------
# Series
# --------------------------------------------------------------------------

@register("duplicate_mean", f"""WITH {HOURLY} SELECT producer, metric, ts, round(avg(value), 6) AS value
  FROM hourly GROUP BY producer, metric, ts""")
def duplicate_mean(spark, sf):
    return rounded(S.mean_duplicates(V.hourly_samples(spark, sf)), "value")


@register("aligned_series", f"WITH {ALIGNED} SELECT producer, ts, {_rounds(METRICS)} FROM aligned")
def aligned_series(spark, sf):
    return rounded(S.align(V.hourly_samples(spark, sf)), *METRICS)


def _outer_chain() -> str:
    chain = " ".join(
        f"FULL OUTER JOIN (SELECT producer, ts, avg(value) AS {m} FROM hourly WHERE metric = '{m}' GROUP BY ALL) t{i} "
        "USING (producer, ts)" for i, m in enumerate(METRICS[1:], start=1)
    )
    return (f"WITH {HOURLY} SELECT producer, ts, {_rounds(METRICS)} FROM (SELECT producer, ts, avg(value) AS "
            f"{METRICS[0]} FROM hourly WHERE metric = '{METRICS[0]}' GROUP BY ALL) t0 {chain}")


@register("aligned_by_joins", _outer_chain())
def aligned_by_joins(spark, sf):
    return rounded(S.align_by_joins(V.hourly_samples(spark, sf)), *METRICS)


@register("forward_fill", f"WITH {FILLED} SELECT producer, ts, {_rounds(METRICS)} FROM filled")
def forward_fill(spark, sf):
    return rounded(S.fill_forward(V.hourly_samples(spark, sf)), *METRICS)


_WIDE_SQL = f"WITH {WIDE} SELECT producer, ts, {_rounds(METRICS)} FROM wide"


@register("wide_table", _WIDE_SQL)
def wide_table(spark, sf):
    return rounded(S.wide_table(V.hourly_samples(spark, sf)), *METRICS)


@register("wide_table_chunked", _WIDE_SQL)
def wide_table_chunked(spark, sf):
    return rounded(S.wide_table(V.hourly_samples(spark, sf), target_rows=300), *METRICS)


_DIFF_SQL = f"""WITH {SAMPLES} SELECT producer, metric, ts, value, seq,
  round(value - lag(value) OVER (PARTITION BY producer, metric ORDER BY seq), 6) AS diff FROM samples"""


@register("first_difference", _DIFF_SQL)
def first_difference(spark, sf):
    return rounded(S.first_difference(V.metric_samples(spark, sf)), "diff")


@register("first_difference_chunked", _DIFF_SQL)
def first_difference_chunked(spark, sf):
    return rounded(S.first_difference(V.metric_samples(spark, sf), target_rows=40), "diff")


_INTERPOLATE_SQL = f"""WITH {ALIGNED}, n AS (
    SELECT producer, ts, CPU, row_number() OVER (PARTITION BY producer ORDER BY ts) - 1 AS pos FROM aligned),
  k AS (SELECT *, CASE WHEN CPU IS NOT NULL THEN pos END AS kp FROM n),
  b AS (SELECT *, last_value(CPU IGNORE NULLS) OVER f AS v0, last_value(kp IGNORE NULLS) OVER f AS p0,
               first_value(CPU IGNORE NULLS) OVER g AS v1, first_value(kp IGNORE NULLS) OVER g AS p1
        FROM k WINDOW f AS (PARTITION BY producer ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                      g AS (PARTITION BY producer ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  SELECT producer, ts, pos, round(CPU, 6) AS CPU,
         round(CASE WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL OR p1 = p0 THEN v0
                    ELSE v0 + (v1 - v0) / (p1 - p0) * (pos - p0) END, 6) AS interpolated FROM b"""


@register("interpolation", _INTERPOLATE_SQL)
def interpolation(spark, sf):
    return rounded(S.interpolate(V.hourly_samples(spark, sf), "CPU"), "CPU", "interpolated")


@register("interpolation_chunked", _INTERPOLATE_SQL)
def interpolation_chunked(spark, sf):
    return rounded(S.interpolate(V.hourly_samples(spark, sf), "CPU", target_rows=400), "CPU", "interpolated")


_TREND = f"""{WIDE}, n AS (
    SELECT producer, ts, Throughput AS observed, row_number() OVER (PARTITION BY producer ORDER BY ts) - 1 AS pos,
           count(*) OVER (PARTITION BY producer) AS total FROM wide),
  t AS (SELECT *, CASE WHEN pos >= 15 AND pos < total - 15 THEN
            (sum(observed) OVER (PARTITION BY producer ORDER BY pos ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING)
             + 0.5 * (lag(observed, 15) OVER (PARTITION BY producer ORDER BY pos)
                      + lead(observed, 15) OVER (PARTITION BY producer ORDER BY pos))) / 30 END AS trend FROM n)"""


@register("centred_trend", f"WITH {_TREND} SELECT producer, pos, round(observed, 6) AS observed, round(trend, 6) AS trend FROM t")
def centred_trend(spark, sf):
    """Trend in blocks of 100 positions, so that block edges are exercised."""
    series = cut(S.wide_table(V.hourly_samples(spark, sf), ["Throughput"]), ["producer"], "ts").run(position("pos"))
    observed = series.result().select("producer", "pos", F.col("Throughput").alias("observed"))
    return rounded(S.trend(observed, "observed", block_rows=100), "observed", "trend")


@register("series_position", f"""WITH {SAMPLES} SELECT producer, metric, seq,
  row_number() OVER (PARTITION BY producer, metric ORDER BY seq) - 1 AS pos FROM samples""")
def series_position(spark, sf):
    return S.positions(V.metric_samples(spark, sf), target_rows=40).select("producer", "metric", "seq", "pos")


@register("frame_markers", f"""WITH {SAMPLES}, n AS (SELECT producer, metric, seq,
  row_number() OVER (PARTITION BY producer, metric ORDER BY seq) AS nth FROM samples)
  SELECT * FROM n WHERE nth % 100 = 0""")
def frame_markers(spark, sf):
    """Every 100th sample of a series, the progress marker of a producer."""
    return S.frame_markers(V.metric_samples(spark, sf)).select("producer", "metric", "seq", "nth")


_DECOMPOSE = f"""{_TREND}, s AS (
    SELECT producer, pos % 30 AS k, avg(observed - trend) AS raw FROM t GROUP BY 1, 2),
  c AS (SELECT producer, k, raw - avg(raw) OVER (PARTITION BY producer) AS seasonal FROM s),
  d AS (SELECT t.producer, t.ts, t.pos, observed, trend, seasonal, observed - trend - seasonal AS resid
        FROM t JOIN c ON t.producer = c.producer AND t.pos % 30 = c.k WHERE total >= 60)"""
_COMPONENTS = ["observed", "trend", "seasonal", "resid"]
_DECOMPOSE_SQL = f"WITH {_DECOMPOSE} SELECT producer, ts, pos, {_rounds(_COMPONENTS)} FROM d"


@register("seasonal_decomposition", _DECOMPOSE_SQL)
def seasonal_decomposition(spark, sf):
    return rounded(decompose(V.hourly_samples(spark, sf)), *_COMPONENTS)


@register("seasonal_decomposition_chunked", _DECOMPOSE_SQL)
def seasonal_decomposition_chunked(spark, sf):
    return rounded(decompose(V.hourly_samples(spark, sf), target_rows=250), *_COMPONENTS)


@register("short_series", f"""WITH {SAMPLES}, n AS (SELECT producer || '/' || metric AS producer, count(DISTINCT ts) AS rows
  FROM samples GROUP BY 1) SELECT * FROM n WHERE rows < 400""")
def short_series(spark, sf):
    """Series with fewer than two full periods of 200 samples."""
    named = V.metric_samples(spark, sf).withColumn("producer", F.concat_ws("/", "producer", "metric"))
    return too_short(named, period=200)


@register("anomaly_flags", f"""WITH {_DECOMPOSE}, spreads AS (SELECT producer, stddev_pop(resid) AS spread FROM d GROUP BY 1)
  SELECT producer, pos, round(resid, 6) AS resid, coalesce(abs(resid) > 3 * spread, false) AS anomaly
  FROM d JOIN spreads USING (producer)""")
def anomaly_flags(spark, sf):
    flagged = A.flag_anomalies(V.hourly_samples(spark, sf))
    return rounded(flagged.select("producer", "pos", "resid", "anomaly"), "resid")


# --------------------------------------------------------------------------
# Analysis
# --------------------------------------------------------------------------

def _correlation_sql() -> str:
    rows = []
    for a in CORRELATED_METRICS:
        for b in CORRELATED_METRICS:
            r = f"corr({a}, {b})" if a != b else f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
            rows.append(f"SELECT producer, '{a}' AS metric_a, '{b}' AS metric_b, round({r}, 6) AS r FROM wide GROUP BY producer")
    return f"WITH {WIDE} " + " UNION ALL ".join(rows)


@register("correlation_matrix", _correlation_sql())
def correlations(spark, sf):
    samples = V.hourly_samples(spark, sf)
    return rounded(correlation_matrix(S.wide_table(samples, CORRELATED_METRICS), bound=samples), "r")


_BOTTLENECKS = f"""{WIDE}, b AS (
  SELECT producer, max(CPU) AS max_cpu, max(Memory) AS max_memory, quantile_cont(Memory, 0.9) AS memory_q90
  FROM wide GROUP BY producer), found AS (SELECT *, list_filter([CASE WHEN max_cpu > 90 THEN '{A.HIGH_CPU}' END,
  CASE WHEN max_memory > memory_q90 THEN '{A.HIGH_MEMORY}' END], lambda x: x IS NOT NULL) AS bottlenecks FROM b)"""


@register("bottlenecks", f"""WITH {_BOTTLENECKS} SELECT producer, round(max_cpu, 6) AS max_cpu,
  round(max_memory, 6) AS max_memory, round(memory_q90, 6) AS memory_q90,
  array_to_string(bottlenecks, '; ') AS bottlenecks FROM found""")
def bottlenecks(spark, sf):
    samples = V.hourly_samples(spark, sf)
    found = A.bottlenecks(S.wide_table(samples, ["CPU", "Memory"]), bound=samples)
    return rounded(found.withColumn("bottlenecks", F.array_join("bottlenecks", "; ")), "max_cpu", "max_memory", "memory_q90")


@register("bottleneck_points", f"""WITH {WIDE}
  SELECT producer, ts, 'CPU vs Throughput' AS pair, round(CPU, 6) AS x, round(Throughput, 6) AS y FROM wide
  UNION ALL SELECT producer, ts, 'Memory vs Latency', round(Memory, 6), round(Avg_latency, 6) FROM wide
  UNION ALL SELECT producer, ts, 'Network I/O vs Frame Production', round(Network_received + Network_sent, 6), round(Frame_prod, 6) FROM wide
  UNION ALL SELECT producer, ts, 'Disk I/O vs Consumption Time', round(Disk_read + Disk_write, 6), round(Msg_cons_time, 6) FROM wide""")
def bottleneck_points(spark, sf):
    return rounded(A.bottleneck_pairs(S.wide_table(V.hourly_samples(spark, sf))), "x", "y")


_EFFICIENCY = """efficiency AS (SELECT producer, avg(Frame_prod / (CPU + 0.01)) AS avg_cpu_efficiency,
  avg(Frame_prod / (Memory + 0.01)) AS avg_mem_efficiency FROM wide GROUP BY producer)"""


@register("resource_efficiency", f"WITH {WIDE}, {_EFFICIENCY} SELECT producer, {_rounds(['avg_cpu_efficiency', 'avg_mem_efficiency'])} FROM efficiency")
def resource_efficiency(spark, sf):
    wide = S.wide_table(V.hourly_samples(spark, sf), ["CPU", "Memory", "Frame_prod"])
    return rounded(A.resource_efficiency(wide), "avg_cpu_efficiency", "avg_mem_efficiency")


@register("efficiency_ratios", f"""WITH {WIDE} SELECT producer, ts, round(Frame_prod / (CPU + 0.01), 6) AS frames_per_cpu,
  round(Frame_prod / (Memory + 0.01), 6) AS frames_per_mem FROM wide""")
def efficiency_ratios(spark, sf):
    wide = S.wide_table(V.hourly_samples(spark, sf), ["CPU", "Memory", "Frame_prod"])
    ratios = A.efficiency_ratios(wide).select("producer", "ts", "frames_per_cpu", "frames_per_mem")
    return rounded(ratios, "frames_per_cpu", "frames_per_mem")


@register("analysis_summary", f"""WITH {_BOTTLENECKS}, {_EFFICIENCY}, present AS (
    SELECT producer, list(DISTINCT metric) AS have FROM hourly GROUP BY producer)
  SELECT producer, 'ANALYZING: ' || upper(producer) AS heading,
    CASE WHEN len(bottlenecks) > 0 THEN array_to_string(bottlenecks, '; ') ELSE 'None' END AS findings,
    round(avg_cpu_efficiency, 6) AS avg_cpu_efficiency, round(avg_mem_efficiency, 6) AS avg_mem_efficiency,
    {len(METRICS)} - len(have) AS missing
  FROM found JOIN efficiency USING (producer) JOIN present USING (producer)""")
def analysis_summary(spark, sf):
    summary = A.analysis_summary(V.hourly_samples(spark, sf)).withColumn("missing", F.size("missing_metrics").cast("long"))
    chosen = summary.select("producer", "heading", "findings", "avg_cpu_efficiency", "avg_mem_efficiency", "missing")
    return rounded(chosen, "avg_cpu_efficiency", "avg_mem_efficiency")


# --------------------------------------------------------------------------
# Operational metrics
# --------------------------------------------------------------------------

NOW = "2024-02-01 00:00:00"


def _measured(spark, sf):
    messages = C.with_scrape_labels(V.messages(spark, sf))
    return C.measure_messages(messages, F.lit(NOW).cast("timestamp"))


_MEASURED = f"""{MESSAGES}, measured AS (SELECT *, (epoch_us(TIMESTAMP '{NOW}') // 1000 - epoch_us("timestamp") // 1000) / 1000.0 AS lag_seconds,
  octet_length(encode(props)) AS size_bytes FROM messages)"""


@register("message_measures", f"""WITH {_MEASURED} SELECT "offset", application, instance, job,
  round(lag_seconds, 6) AS lag_seconds, size_bytes::INT AS size_bytes FROM measured""")
def message_measures(spark, sf):
    return rounded(_measured(spark, sf).select("offset", *C.LABELS, "lag_seconds", "size_bytes"), "lag_seconds")


@register("scrape_labels", """WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN c_name
    ELSE 'client' || (c_custkey % 5) || ':' || (9080 + c_custkey % 5) END AS address FROM customer)
  SELECT c_custkey, address AS instance, nullif(regexp_extract(address, '^([^:]+):\\d+$', 1), '') AS application,
    nullif(regexp_extract(address, '^([^:]+):\\d+$', 1), '') AS job FROM a""")
def scrape_labels(spark, sf):
    """Labels from addresses; names without a port get no application."""
    key = F.col("c_custkey")
    address = F.when(key % 7 == 0, F.col("c_name")).otherwise(
        F.concat(F.lit("client"), key % 5, F.lit(":"), key % 5 + 9080)
    )
    named = V.table(spark, sf, "customer").select("c_custkey", address.alias("address"))
    return C.with_scrape_labels(named).select("c_custkey", "instance", "application", "job")


_OUTCOME = {"error": "frame_error", "signup": "sink_error", "purchase": "read_error"}


@register("producer_counters", f"""WITH {MESSAGES} SELECT application, instance, job,
  count(*) FILTER (event_type IN ('view', 'click', 'signup')) AS frames_produced_total,
  count(*) FILTER (event_type = 'error') AS frame_production_errors_total,
  count(*) FILTER (event_type = 'signup') AS producer_errors_total,
  count(*) FILTER (event_type = 'purchase') AS read_errors_total FROM messages GROUP BY ALL""")
def producer_counters(spark, sf):
    outcome = F.lit("ok")
    for kind, name in _OUTCOME.items():
        outcome = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(outcome)
    return C.producer_counters(C.with_scrape_labels(V.messages(spark, sf)).withColumn("outcome", outcome))


@register("consumer_counters", f"""WITH {MESSAGES} SELECT application, instance, job, count(*) AS messages_consumed_total,
  count(*) FILTER (event_type = 'error') AS message_consumption_errors_total FROM messages GROUP BY ALL""")
def consumer_counters(spark, sf):
    return C.consumer_counters(C.with_scrape_labels(V.messages(spark, sf)), F.col("event_type") == "error")


def _histogram_sql(bounds) -> str:
    buckets = [*[(str(float(b)), f"count(*) FILTER (seconds <= {b}::DOUBLE)") for b in bounds], ("+Inf", "count(seconds)")]
    return f"WITH {MESSAGES} " + " UNION ALL ".join(
        f"SELECT application, instance, job, '{le}' AS le, {cell} AS bucket, count(seconds) AS count, "
        f"round(sum(seconds), 6) AS sum FROM messages GROUP BY application, instance, job" for le, cell in buckets
    )


@register("frame_time_histogram", _histogram_sql(FRAME_TIME_BUCKETS))
def frame_time_histogram(spark, sf):
    return rounded(C.histogram(C.with_scrape_labels(V.messages(spark, sf)), "seconds", FRAME_TIME_BUCKETS), "sum")


@register("consumption_time_histogram", _histogram_sql(DEFAULT_BUCKETS))
def consumption_time_histogram(spark, sf):
    return rounded(C.histogram(C.with_scrape_labels(V.messages(spark, sf)), "seconds", DEFAULT_BUCKETS), "sum")


@register("latest_gauges", f"""WITH {_MEASURED} SELECT application, instance, job, round(arg_max(lag_seconds, "timestamp"), 6) AS lag_seconds,
  arg_max(size_bytes, "timestamp")::INT AS size_bytes, round(arg_max(seconds, "timestamp"), 6) AS seconds FROM measured GROUP BY ALL""")
def latest_gauges(spark, sf):
    return rounded(C.gauges(_measured(spark, sf), ["lag_seconds", "size_bytes", "seconds"], "timestamp"), "lag_seconds", "seconds")


@register("scraped_gauge", f"""WITH {MESSAGES} SELECT application, instance, job,
  time_bucket(INTERVAL 2 SECONDS, "timestamp") + INTERVAL 2 SECONDS AS ts, round(arg_max(seconds, "timestamp"), 6) AS value
  FROM messages GROUP BY ALL""")
def scraped_gauge(spark, sf):
    return rounded(C.scrape(C.with_scrape_labels(V.messages(spark, sf)), "timestamp", "seconds"), "value")


@register("scraped_grid", f"""WITH {MESSAGES}, s AS (SELECT application, instance, job,
    time_bucket(INTERVAL 10 MINUTES, "timestamp") + INTERVAL 10 MINUTES AS ts, arg_max(seconds, "timestamp") AS value
    FROM messages GROUP BY ALL),
  r AS (SELECT application, instance, job, min(ts) AS t0, max(ts) AS t1 FROM s GROUP BY ALL),
  g AS (SELECT application, instance, job, unnest(generate_series(t0, t1, INTERVAL 10 MINUTES)) AS ts FROM r)
  SELECT application, instance, job, ts, round(last_value(s.value IGNORE NULLS) OVER (PARTITION BY application, instance, job
    ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
  FROM g LEFT JOIN s USING (application, instance, job, ts)""")
def scraped_grid(spark, sf):
    """Scrapes every ten minutes, repeating the last value in quiet intervals."""
    scraped = C.scrape(C.with_scrape_labels(V.messages(spark, sf)), "timestamp", "seconds", "10 minutes")
    return rounded(C.scrape_grid(scraped, 600, block=1000, target_rows=1500), "value")


@register("scraped_counter", f"""WITH {MESSAGES}, s AS (SELECT application, instance, job,
    time_bucket(INTERVAL 2 SECONDS, "timestamp") + INTERVAL 2 SECONDS AS ts, count(*) AS increase FROM messages GROUP BY ALL)
  SELECT application, instance, job, ts, increase, (sum(increase) OVER (PARTITION BY application, instance, job ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS value FROM s""")
def scraped_counter(spark, sf):
    return C.scrape_counter(C.with_scrape_labels(V.messages(spark, sf)), "timestamp", 2)


# --------------------------------------------------------------------------
# Frames
# --------------------------------------------------------------------------

TEXT_FRAME = FrameShape(8, 8, 1)


def _containers(spark, sf):
    """Documents as raw containers: the text's bytes are frames back to back."""
    return V.table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.encode("text", "UTF-8").alias("content"))


_SPLIT = """raw AS (SELECT doc_id AS path, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents),
  split AS (SELECT path, i AS frame_seq, substr(h, (i * 128 + 1)::BIGINT, 128) AS data
            FROM (SELECT path, h, unnest(range(n // 64)) AS i FROM raw))"""


@register("raw_frames", f"WITH {_SPLIT} SELECT path, frame_seq, data FROM split")
def raw_frames(spark, sf):
    return FR.split_raw(_containers(spark, sf), TEXT_FRAME).withColumn("data", F.hex("data"))


@register("partial_frames", """SELECT doc_id AS path, (octet_length(encode(text)) % 64)::INT AS leftover_bytes FROM documents
  WHERE octet_length(encode(text)) % 64 > 0""")
def partial_frames(spark, sf):
    return FR.split_leftovers(_containers(spark, sf), TEXT_FRAME)


@register("frame_envelopes", f"""WITH {_SPLIT} SELECT path::VARCHAR AS video, frame_seq,
  TIMESTAMP '2024-01-01' + to_milliseconds(frame_seq * 500) AS ts, 8 AS width, 8 AS height, 1 AS channels,
  (length(data) // 2)::INT AS size_bytes FROM split""")
def frame_envelopes(spark, sf):
    frames = FR.split_raw(_containers(spark, sf), TEXT_FRAME).withColumn("path", F.col("path").cast("string"))
    return FR.envelope(frames, TEXT_FRAME, F.lit("2024-01-01").cast("timestamp"), rate=2.0).drop("data")


_RESAMPLED = f"WITH {_SPLIT} SELECT path, frame_seq FROM split WHERE frame_seq = 0 OR (frame_seq * 2) // 5 <> ((frame_seq - 1) * 2) // 5"


@register("constant_rate_frames", _RESAMPLED)
def constant_rate_frames(spark, sf):
    """From 5 to 2 frames per second: the first frame of every half second."""
    frames = FR.split_raw(_containers(spark, sf), TEXT_FRAME)
    return FR.resample_constant(frames, 5.0, 2.0).select("path", "frame_seq")


@register("resampled_frames", f"""WITH {SAMPLES} SELECT producer, min(seq) AS seq, arg_min(value, seq) AS value
  FROM samples GROUP BY producer, date_trunc('hour', ts)""")
def resampled_frames(spark, sf):
    """First sample per producer and hour, the rate rule for irregular times."""
    samples = V.metric_samples(spark, sf).select("producer", "ts", "seq", "value")
    return FR.resample(samples, 1 / 3600, "producer", "ts", "seq").select("producer", "seq", "value")


def _hex_of(cells: list[str]) -> str:
    """SQL for the hex text of a list of integer expressions."""
    return " || ".join(f"lpad(upper(to_hex({c})), 2, '0')" for c in cells)


def _shrink_cells(side: int, cell) -> list[str]:
    return [
        f"({cell(4 * y + 1, 4 * x + 1)} + {cell(4 * y + 1, 4 * x + 2)} + {cell(4 * y + 2, 4 * x + 1)} + {cell(4 * y + 2, 4 * x + 2)} + 2) // 4"
        for y in range(side) for x in range(side)
    ]


_SHRINK_SQL = f"WITH {PIXELS} SELECT vec_id, {_hex_of(_shrink_cells(2, lambda y, x: f'px[{8 * y + x + 1}]'))} AS data FROM pixels"


@register("resized_frames", _SHRINK_SQL)
def resized_frames(spark, sf):
    """8x8 to 2x2, the 4:1 shrink of the frame job."""
    frames = V.frames8(spark, sf)
    made = resize_frame(F.col("data"), FrameShape(8, 8, 1), 2, 2)
    return frames.select("vec_id", F.hex(made["data"]).alias("data"))


def _bilinear_sql(source: int, target: int) -> str:
    def axis(i: int) -> tuple[int, int, int]:
        centre = (i + 0.5) * source / target - 0.5
        left = int(centre // 1)
        return left, min(left + 1, source - 1), round((centre - left) * 2048)

    cells = []
    for y in range(target):
        top, bottom, wy = axis(y)
        for x in range(target):
            left, right, wx = axis(x)

            def row(r: int) -> str:
                return f"((px[{source * r + left + 1}] * {2048 - wx} + px[{source * r + right + 1}] * {wx}) // 16)"

            cells.append(f"(({2048 - wy} * {row(top)}) // 65536 + ({wy} * {row(bottom)}) // 65536 + 2) // 4")
    return f"WITH {PIXELS} SELECT vec_id, {_hex_of(cells)} AS data FROM pixels"


@register("bilinear_frames", _bilinear_sql(8, 3))
def bilinear_frames(spark, sf):
    """8x8 to 3x3, the rule for images of any size."""
    made = resize_frame(F.col("data"), FrameShape(8, 8, 1), 3, 3)
    return V.frames8(spark, sf).select("vec_id", F.hex(made["data"]).alias("data"))


def _gray_cell(y: int, x: int) -> str:
    v = f"px[{8 * y + x + 1}]"
    return f"((3735 * {v} + 19235 * (255 - {v}) + 9798 * ({v} * 7 % 256) + 16384) // 32768)"


_GRAY_SQL = f"WITH {PIXELS} SELECT vec_id, {_hex_of(_shrink_cells(2, _gray_cell))} AS data FROM pixels"


@register("gray_frames", _GRAY_SQL)
def gray_frames(spark, sf):
    made = gray_frame(F.col("data"), FrameShape(8, 8, 3), 2, 2)
    return V.frames8(spark, sf, color=True).select("vec_id", F.hex(made["data"]).alias("data"))


@register("transformed_frames", _GRAY_SQL)
def transformed_frames(spark, sf):
    """The same through the pipeline stage."""
    stage = FR.FrameTransformer(inputCol="data", outputCol="small", sourceHeight=8, sourceWidth=8, height=2, width=2)
    return stage.transform(V.frames8(spark, sf, color=True)).select("vec_id", F.hex("small").alias("data"))


@register("frame_errors", """SELECT doc_id AS path, CASE WHEN n <> 64 THEN 'frame size ' || n || ' is not 64' END AS error, CASE WHEN n = 64 THEN 4 END AS small_bytes
  FROM (SELECT doc_id, octet_length(encode(CASE WHEN doc_id % 2 = 0 THEN rpad(lang || source, 64, '.') ELSE lang || source END)) AS n FROM documents)""")
def frame_errors(spark, sf):
    """Payloads that are no frame give a message and a null, never a failure; every other document is made a frame."""
    named = F.concat("lang", "source")
    payload = F.when(F.col("doc_id") % 2 == 0, F.rpad(named, 64, ".")).otherwise(named)
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.encode(payload, "UTF-8").alias("data"))
    return FR.resize_frames(docs, TEXT_FRAME, 2, 2).select("path", "error", F.octet_length("data").alias("small_bytes"))


def _wide_cells(x: int, channel: int) -> str:
    """A thumbnail byte of a frame whose rows repeat one 64-byte pattern."""
    a, b = (3 * (4 * x + 1) + channel) % 64, (3 * (4 * x + 2) + channel) % 64
    return f"((2 * px[{a + 1}] + 2 * px[{b + 1}] + 2) // 4)"


def full_frames(spark, sf):
    """256x256x3 frames, an 8x8 frame's bytes 3072 times; spread before they grow."""
    spread = V.frames8(spark, sf).repartition(spark.sparkContext.defaultParallelism, "vec_id")
    return spread.select("vec_id", F.unhex(F.repeat(F.hex("data"), 3072)).alias("data"))


@register("full_size_frames", f"""WITH {PIXELS} SELECT vec_id, md5(unhex(repeat({_hex_of([_wide_cells(x, c) for x in range(16) for c in range(3)])}, 256))) AS digest
  FROM pixels""")
def full_size_frames(spark, sf):
    """256x256x3 frames to 64x64x3: the frame job at its real frame size."""
    return FR.resize_frames(full_frames(spark, sf)).select("vec_id", F.md5("data").alias("digest"))


@register("feature_values", f"""WITH {PIXELS} SELECT vec_id, array_to_string(list_transform(px, lambda v:
  (CASE WHEN v > 127 THEN v - 256 ELSE v END)), ',') AS features FROM pixels""")
def feature_values(spark, sf):
    """Feature values of a frame, signed like JVM bytes."""
    values = vector_to_array(array_to_vector(signed_values(F.col("data"))))
    return V.frames8(spark, sf).select("vec_id", F.concat_ws(",", values.cast("array<int>")).alias("features"))


@register("non_empty_payloads", """SELECT doc_id, hex(encode(regexp_replace(text, '[^0-9]', '', 'g'))) AS data FROM documents
  WHERE regexp_replace(text, '[^0-9]', '', 'g') <> ''""")
def non_empty_payloads(spark, sf):
    """All digits of a text as its payload; texts without any have an empty one."""
    payload = F.encode(F.regexp_replace("text", "[^0-9]", ""), "UTF-8")
    docs = V.table(spark, sf, "documents").select("doc_id", payload.alias("data"))
    return FR.drop_empty(docs).withColumn("data", F.hex("data"))


# --------------------------------------------------------------------------
# Lists, files, names
# --------------------------------------------------------------------------

@register("metric_file_samples", f"""WITH {SAMPLES}, t AS (SELECT producer, metric, value, CASE seq % 4
      WHEN 0 THEN strftime(ts, '%H:%M:%S') WHEN 1 THEN strftime(ts, '%H:%M:%S.%f')
      WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE 'n/a' END AS txt FROM samples),
  p AS (SELECT *, coalesce(try_strptime(txt, '%H:%M:%S'), try_strptime(txt, '%H:%M:%S.%f'),
      try_strptime(txt, '%Y-%m-%d %H:%M:%S')) AS ts FROM t)
  SELECT producer, metric, ts::TIMESTAMP AS ts, round(avg(value), 6) AS value FROM p WHERE ts IS NOT NULL GROUP BY ALL""")
def metric_file_samples(spark, sf):
    """File path and text timestamp to series; duplicates averaged."""
    kind = F.col("seq") % 4
    text = (
        F.when(kind == 0, F.date_format("ts", "HH:mm:ss"))
        .when(kind == 1, F.date_format("ts", "HH:mm:ss.SSSSSS"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit("n/a"))
    )
    path = F.concat(F.lit("file:/data/"), "producer", F.lit("/"), "metric", F.lit(".csv"))
    rows = V.metric_samples(spark, sf).select(path.alias("path"), text.alias("txt"), "value")
    located = SF.series_of_path(rows, "path").withColumn("ts", SF.parse_sample_time(F.col("txt")))
    return rounded(S.mean_duplicates(located), "value")


#: A seventh of the samples is NaN in the files, an eleventh empty: no value, but a row.
GAPPED = SAMPLES.replace("ts, value,", "date_trunc('hour', ts)::TIMESTAMP AS ts, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN value END AS value,")


def _metric_files(spark, sf):
    """The samples as CSV files, a folder per producer and metric, read back."""
    value = F.when(F.col("seq") % 7 == 0, "NaN").when(F.col("seq") % 11 != 0, F.col("value").cast("string"))
    rows = V.hourly_samples(spark, sf).select(
        "producer", F.concat("metric", F.lit(".csv")).alias("metric"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), value.alias("value"), "seq")
    path = scratch_path(spark, "metric-files")
    in_order = rows.repartition("producer", "metric").sortWithinPartitions("producer", "metric", "seq").drop("seq")
    in_order.write.partitionBy("producer", "metric").csv(path)
    return SF.read_metric_files(spark, path)


#: Statistics of values; "last value" is that of the last row, which may have none.
_VALUE_STATS = [n for n in STAT_SQL if not n.endswith("_total")]


@register("metric_files_statistics", _stats_sql(_VALUE_STATS, GAPPED))
def metric_files_statistics(spark, sf):
    """The report's statistics from files with NaN and empty values."""
    return rounded(R.producer_stats(_metric_files(spark, sf)).select("producer", *_VALUE_STATS), *_VALUE_STATS)


@register("metric_files_samples", f"""WITH {GAPPED} SELECT producer, metric, ts, count(*) AS rows, count(value) AS filled, round(sum(value), 6) AS total
  FROM samples GROUP BY ALL""")
def metric_files_samples(spark, sf):
    """What the files hold, by producer, metric and hour."""
    found = _metric_files(spark, sf).groupBy("producer", "metric", "ts").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("filled"), F.sum("value").alias("total"))
    return rounded(found, "total")


@register("missing_metric_files", f"""WITH s AS (SELECT DISTINCT user_id::VARCHAR AS producer, ({_sql_list(METRICS)})[event_id % 12 + 1] AS metric FROM events),
  e AS (SELECT DISTINCT producer, unnest({_sql_list(METRICS)}) AS metric FROM s)
  SELECT producer, metric FROM e ANTI JOIN s USING (producer, metric)""")
def missing_metric_files(spark, sf):
    """Every user as a producer: which of the twelve series it never wrote."""
    events = V.table(spark, sf, "events")
    named = V.metric_samples_from_events(events, F.col("user_id").cast("string"))
    return SF.missing_files(named)


@register("metric_display_names", f"WITH {SAMPLES}, names(metric, display_name) AS (VALUES " + ", ".join(
    f"('{m}', '{d}')" for m, d in METRIC_DISPLAY_NAMES.items()
) + ") SELECT display_name, metric || '.csv' AS file_name, count(*) AS rows FROM samples JOIN names USING (metric) GROUP BY ALL")
def metric_display_names(spark, sf):
    names = F.create_map(*[F.lit(v) for pair in METRIC_DISPLAY_NAMES.items() for v in pair])
    named = V.metric_samples(spark, sf).select(
        names[F.col("metric")].alias("display_name"), F.concat("metric", F.lit(".csv")).alias("file_name")
    )
    return named.groupBy("display_name", "file_name").agg(F.count("*").alias("rows"))


@register("video_names", """WITH n AS (SELECT p_partkey, printf('video_%02d.mp4', p_partkey) AS name FROM part)
  SELECT name, row_number() OVER (ORDER BY name) - 1 AS frame_seq FROM n WHERE regexp_full_match(name, 'video_[0-9]{2}\\.mp4')""")
def video_names(spark, sf):
    """Names that fit the two-digit pattern, numbered in name order."""
    paths = V.table(spark, sf, "part").select(F.concat(F.lit("/videos/"), X.video_name(F.col("p_partkey"))).alias("path"))
    files = paths.select(X.parent_name(F.col("path")).alias("folder"), X.base_name(F.col("path")).alias("name"))
    return S.ordered_files(files.filter(X.is_video_name(F.col("name")))).select("name", "frame_seq")


@register("image_numbers", """SELECT source AS folder, 'img_' || doc_id || '.JPG' AS name,
  row_number() OVER (PARTITION BY source ORDER BY 'img_' || doc_id || '.JPG') - 1 AS frame_seq FROM documents""")
def image_numbers(spark, sf):
    """Images of a folder as a frame sequence by name."""
    files = V.table(spark, sf, "documents").select(
        F.col("source").alias("folder"), F.format_string("img_%d.JPG", "doc_id").alias("name")
    )
    return S.ordered_files(files, target_rows=20)


_LIST = """lines AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '  img/' || doc_id || '.jpg ' WHEN doc_id % 9 = 1
    THEN '/abs/' || doc_id || '.jpg ' || quality ELSE '  img/' || doc_id || '.jpg' || chr(9) || quality || ' ' END AS value
    FROM documents JOIN labels USING (doc_id)),
  parsed AS (SELECT doc_id, value, regexp_split_to_array(regexp_replace(value, '^\\s+|\\s+$', '', 'g'), '\\s+') AS t FROM lines)"""


def _list_lines(spark, sf):
    lines = V.image_list(spark, sf)
    label = F.element_at(F.split(F.trim("value"), "\t"), -1)
    key = F.col("doc_id")
    value = (
        F.when(key % 9 == 0, F.concat(F.lit("  img/"), key, F.lit(".jpg ")))
        .when(key % 9 == 1, F.concat(F.lit("/abs/"), key, F.lit(".jpg "), label))
        .otherwise(F.col("value"))
    )
    return lines.withColumn("value", value)


@register("parsed_image_list", f"""WITH {_LIST} SELECT doc_id, CASE WHEN len(t) = 2 THEN CASE WHEN starts_with(t[1], '/') THEN t[1]
  ELSE '/data/' || t[1] END END AS image_path, CASE WHEN len(t) = 2 THEN t[2] END AS label,
  CASE WHEN len(t) <> 2 THEN value END AS corrupt FROM parsed""")
def parsed_image_list(spark, sf):
    return L.parse_image_list(_list_lines(spark, sf), "/data", keep=("doc_id",))


@register("merged_lists", """SELECT text AS line, lang AS part FROM documents UNION ALL SELECT text, role FROM conversations
  UNION ALL SELECT text, 'benchmark' FROM benchmark""")
def merged_lists(spark, sf):
    """Three lists as one, duplicates kept."""
    return L.union_lists(
        V.table(spark, sf, "documents").select(F.col("text").alias("line"), F.col("lang").alias("part")),
        V.table(spark, sf, "conversations").select(F.col("text").alias("line"), F.col("role").alias("part")),
        V.table(spark, sf, "benchmark").select(F.col("text").alias("line"), F.lit("benchmark").alias("part")),
    )


def _payloads(spark, sf):
    return V.table(spark, sf, "documents").select(
        F.format_string("file:///img/%d.jpg", "doc_id").alias("path"), F.octet_length("text").alias("bytes")
    )


def _listed(spark, sf):
    return V.table(spark, sf, "labels").select(
        F.format_string("/img/%d.jpg", F.col("doc_id") * 2).alias("image_path"), F.col("quality").cast("string").alias("label")
    )


@register("image_lookup", """SELECT '/img/' || (l.doc_id * 2) || '.jpg' AS image_path, quality::VARCHAR AS label,
  octet_length(encode(text))::INT AS bytes FROM labels l JOIN documents d ON d.doc_id = l.doc_id * 2""")
def image_lookup(spark, sf):
    return SF.lookup_images(_listed(spark, sf), _payloads(spark, sf))


@register("image_lookup_by_shuffle", """SELECT '/img/' || (l.doc_id * 2) || '.jpg' AS image_path, quality::VARCHAR AS label,
  octet_length(encode(text))::INT AS bytes FROM labels l JOIN documents d ON d.doc_id = l.doc_id * 2""")
def image_lookup_by_shuffle(spark, sf):
    """The same for a list too long to broadcast."""
    return SF.lookup_images(_listed(spark, sf), _payloads(spark, sf), limit=10)


@register("unmatched_images", """SELECT '/img/' || (doc_id * 2) || '.jpg' AS image_path, quality::VARCHAR AS label FROM labels l
  WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id * 2)""")
def unmatched_images(spark, sf):
    return SF.unmatched_images(_listed(spark, sf), _payloads(spark, sf))


@register("table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in ("events", "embeddings", "documents", "labels")))
def table_row_counts(spark, sf):
    parts = [
        V.table(spark, sf, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("name"), "rows")
        for t in ("events", "embeddings", "documents", "labels")
    ]
    return L.union_lists(*parts)


@register("copied_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def copied_table(spark, sf):
    """Extract to CSV with a header and read back."""
    source = V.table(spark, sf, "customer")
    path = scratch_path(spark, "copied")
    copy_table(source, path)
    return spark.read.schema(source.schema).option("header", True).csv(path)


@register("stored_image_list", f"""WITH {_LIST} SELECT CASE WHEN starts_with(t[1], '/') THEN t[1] ELSE '/data/' || t[1] END AS image_path,
  t[2] AS label FROM parsed WHERE len(t) = 2""")
def stored_image_list(spark, sf):
    path = scratch_path(spark, "list")
    K.write_image_list(L.parse_image_list(_list_lines(spark, sf), "/data"), path)
    return SF.read_image_list(spark, path)


@register("stored_predictions", "SELECT vec_id, label, vec_id % 10 AS prediction FROM embeddings")
def stored_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    K.write_parquet(_fixed_predictions(spark, sf).select("vec_id", "label", "prediction"), path)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------
# Labels and models
# --------------------------------------------------------------------------

@register("label_index", """WITH n AS (SELECT source AS label, count(*) AS rows FROM documents GROUP BY 1)
  SELECT label, rows, (row_number() OVER (ORDER BY rows DESC, label) - 1)::DOUBLE AS indexedLabel FROM n""")
def label_index(spark, sf):
    indexed = TR.index_labels(V.table(spark, sf, "documents").select(F.col("source").alias("label")))
    return indexed.groupBy("label", "indexedLabel").agg(F.count("*").alias("rows"))


def _bucket_sql(key: str, buckets: int, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}' || {key}), 1, 8))::BIGINT % {buckets})"


@register("down_sample", f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE {_bucket_sql('l_orderkey', 10_000, 'sample')} < 100")
def down_sample(spark, sf):
    """The 1% sample, reproducible from the key."""
    return L.down_sample(V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey")


@register("train_test_split", f"""SELECT doc_id, CASE WHEN {_bucket_sql('doc_id', 10_000, 'split')} < 8000 THEN 'train' ELSE 'test' END AS split,
  {_bucket_sql('doc_id', 3, 'fold')}::INT AS fold FROM documents""")
def train_test_split(spark, sf):
    return L.with_fold(L.with_split(V.table(spark, sf, "documents").select("doc_id"), "doc_id"), "doc_id")


def _fixed_predictions(spark, sf):
    return V.table(spark, sf, "embeddings").withColumn("prediction", F.col("vec_id") % 10)


def _f1_sql(prediction: str) -> str:
    return f"""SELECT sum(support * coalesce(2.0 * tp / nullif(support + predicted, 0), 0)) / sum(support) AS f1,
      sum(tp) / sum(support) AS accuracy, sum(support)::BIGINT AS rows FROM (
        SELECT k, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted, sum(h)::BIGINT AS tp FROM (
          SELECT label AS k, 1 AS s, 0 AS p, (label = {prediction})::INT AS h FROM embeddings
          UNION ALL SELECT {prediction}, 0, 1, 0 FROM embeddings) GROUP BY k)"""


@register("weighted_f1", f"SELECT round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, rows FROM ({_f1_sql('vec_id % 10')})")
def weighted_f1(spark, sf):
    return rounded(L.weighted_f1(_fixed_predictions(spark, sf)), "f1", "accuracy")


_RIVALS = {"Random Forest": "vec_id % 10", "Logistic Regression": "(vec_id * 7 + 3) % 10", "Decision Tree": "(vec_id + label) % 10"}


@register("best_model", " UNION ALL ".join(
    f"SELECT * FROM (SELECT {i} AS priority, '{m}' AS model, round(f1, 6) AS f1 FROM ({_f1_sql(p)}))" for i, (m, p) in enumerate(_RIVALS.items())
).join(["SELECT * FROM (", ") ORDER BY f1 DESC, priority LIMIT 1"]))
def best_model(spark, sf):
    """Three sets of predictions, the one with the best F1."""
    embeddings = V.table(spark, sf, "embeddings")
    scores = [
        rounded(L.weighted_f1(embeddings.withColumn("prediction", F.expr(rule))), "f1").select(
            F.lit(i).alias("priority"), F.lit(name).alias("model"), "f1")
        for i, (name, rule) in enumerate(_RIVALS.items())
    ]
    return TR.best_of_table(L.union_lists(*scores))


def _separable_features(spark, sf):
    """Features whose classes every candidate can part, so that SQL knows the answers.

    The label as ten 0/1 columns (a linear model parts these) and ten times as a
    number (a tree of depth 5 parts those, whichever columns it may look at).
    """
    label = F.col("label").cast("double")
    marks = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (label == i).cast("double"))
    made = V.table(spark, sf, "embeddings").withColumn("features", array_to_vector(F.concat(marks, F.array_repeat(label, 10))))
    vectors = made.select("vec_id", F.concat(F.lit("class"), F.col("label")).alias("label"), "features")
    return TR.index_labels(vectors)


_LABEL_RANKS = """ranks AS (SELECT label, (row_number() OVER (ORDER BY count(*) DESC, 'class' || label) - 1)::DOUBLE AS rank
  FROM embeddings GROUP BY label)"""
#: What a right model predicts is the label's rank; its F1 comes from the counts, as for any prediction.
_RIGHT_F1 = f"""SELECT sum(n * 2.0 * hit / (n + told)) / sum(n) AS f1 FROM (SELECT label, count(*) AS n, count(*) FILTER (told = rank) AS hit
  FROM told GROUP BY label) JOIN (SELECT rank, label FROM ranks) USING (label) JOIN (SELECT told AS rank, count(*) AS told FROM told GROUP BY 1) USING (rank)"""


@register("trained_models", f"""WITH {_LABEL_RANKS}, told AS (SELECT label, rank, rank AS told FROM embeddings JOIN ranks USING (label)), score AS ({_RIGHT_F1})
  SELECT priority, model, round(f1, 6) AS f1, priority = 0 AS best FROM score, (VALUES (0::BIGINT, 'Random Forest'), (1, 'Logistic Regression'),
    (2, 'Decision Tree')) m(priority, model)""")
def trained_models(spark, sf):
    """Cross-validated classifiers on the embeddings' labels, with their held-out F1; on a tie the first is the best."""
    best, scored = TR.fit_and_select(_separable_features(spark, sf), "vec_id")
    return rounded(TR.score_table(spark, best, scored), "f1")


@register("predictions", f"""WITH {_LABEL_RANKS} SELECT vec_id, rank AS prediction, 1.0::DOUBLE AS probability_sum,
  (SELECT count(*) FROM ranks)::INT AS classes FROM embeddings JOIN ranks USING (label)""")
def predictions(spark, sf):
    """A model is fitted, saved, loaded and applied to all rows; it tells every row's label index."""
    features = _separable_features(spark, sf)
    regression = TR.candidates()[1]
    path = scratch_path(spark, "model")
    K.save_model(regression.pipeline.fit(features), path)
    scored = TR.PipelineModel.load(path).transform(features)
    chances = vector_to_array("probability")
    total = F.aggregate(chances, F.lit(0.0), lambda acc, p: acc + p)
    return scored.select("vec_id", "prediction", F.round(total, 6).alias("probability_sum"), F.size(chances).alias("classes"))


# --------------------------------------------------------------------------
# Streams
# --------------------------------------------------------------------------

def _stream(spark, sf, name):
    """A table as a file stream, be it one file or a folder of files, partitioned or not."""
    schema = V.table(spark, sf, name).schema
    # A pattern, since a stream takes no path of a single file; partition columns are read from the names below ``basePath``.
    return spark.readStream.schema(schema).option("basePath", sf).parquet(f"{sf}/{{{name}}}.parquet")


def _drained(spark, df, name):
    path = scratch_path(spark, name)
    J.drain_to_table(df, path, f"{path}.checkpoint")
    return spark.read.parquet(path)


@register("stream_resized_frames", _SHRINK_SQL)
def stream_resized_frames(spark, sf):
    """The resize job on a stream; the result equals the batch one."""
    frames = V.frames_from_embeddings(_stream(spark, sf, "embeddings"))
    resized = J.resize_stream(frames, FrameShape(8, 8, 1), 2, 2).select("vec_id", "data")
    return _drained(spark, resized, "resized").withColumn("data", F.hex("data"))


@register("stream_raw_frames", f"WITH {_SPLIT} SELECT path, frame_seq, data FROM split")
def stream_raw_frames(spark, sf):
    containers = _stream(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return _drained(spark, J.unfold_videos(containers, TEXT_FRAME), "unfolded").withColumn("data", F.hex("data"))


@register("stream_consumer_metrics", f"""WITH {_MEASURED} SELECT application, instance, job, count(*) AS messages_consumed_total,
  count(*) FILTER (event_type = 'error') AS message_consumption_errors_total, round(arg_max(lag_seconds, "timestamp"), 6) AS lag_seconds,
  sum(size_bytes)::BIGINT AS bytes FROM measured GROUP BY ALL""")
def stream_consumer_metrics(spark, sf):
    """Counters and the lag gauge of the consumer, kept up to date by a stream."""
    messages = C.with_scrape_labels(V.messages_from_events(_stream(spark, sf, "events")))
    measured = C.measure_messages(messages, F.lit(NOW).cast("timestamp"))
    totals = measured.groupBy(*C.LABELS).agg(
        F.count("*").alias("messages_consumed_total"),
        F.count_if(F.col("event_type") == "error").alias("message_consumption_errors_total"),
        F.max_by("lag_seconds", "timestamp").alias("lag_seconds"),
        F.sum("size_bytes").alias("bytes"),
    )
    path = scratch_path(spark, "consumer")
    started = J.writer(totals, f"{path}.checkpoint", mode="complete", once=True).foreachBatch(J.replace_table(path))
    started.start().awaitTermination()
    return rounded(spark.read.parquet(path), "lag_seconds")


@register("stream_consumer_histogram", f"""WITH {_MEASURED}, h AS ({_histogram_sql(DEFAULT_BUCKETS).replace(f"WITH {MESSAGES} ", "")}),
  t AS (SELECT application, instance, job, count(*) AS messages, count(*) FILTER (event_type = 'error') AS failures, sum(size_bytes)::BIGINT AS bytes,
    round(arg_max(lag_seconds, "timestamp"), 6) AS lag_seconds FROM measured GROUP BY ALL)
  SELECT h.*, messages, failures, bytes, lag_seconds FROM h JOIN t USING (application, instance, job)""")
def stream_consumer_histogram(spark, sf):
    """Histogram, failures, bytes and latest lag of a stream of many batches, each adding to the totals before it."""
    folder = scratch_path(spark, "messages")
    C.with_scrape_labels(V.messages(spark, sf)).repartition(4).write.parquet(folder)
    messages = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    path = scratch_path(spark, "totals")

    def summary(batch: DataFrame) -> DataFrame:
        measured = C.measure_messages(batch, F.lit(NOW).cast("timestamp"))
        return TT.consumption_summary(measured, "seconds", F.col("event_type") == "error", latest=("lag_seconds",))

    _drained_outcomes(messages, path, TT.add_to_totals(path, summary))
    totals = TT.read_totals(spark, path)
    rest = totals.select(*C.LABELS, "bytes", F.col("newest.lag_seconds").alias("lag_seconds"))
    return rounded(TT.histogram_rows(totals).join(rest, C.LABELS), "sum", "lag_seconds")


_HOURLY_SCRAPES = f"""{MESSAGES}, s AS (SELECT application, instance, job, time_bucket(INTERVAL 1 HOUR, "timestamp") + INTERVAL 1 HOUR AS ts,
  arg_max(seconds, "timestamp") AS value FROM messages GROUP BY ALL)"""


def _timed_messages(spark, sf):
    messages = C.with_scrape_labels(V.messages_from_events(_stream(spark, sf, "events")))
    return messages.select(*C.LABELS, F.col("timestamp").cast("timestamp").alias("timestamp"), "seconds")


@register("stream_scraped_gauge", f"WITH {_HOURLY_SCRAPES} SELECT application, instance, job, ts, round(value, 6) AS value FROM s")
def stream_scraped_gauge(spark, sf):
    """Hourly scrapes of a stream up to its end; a window closes when the watermark passes it."""
    path = scratch_path(spark, "scraped")
    TK.drain_to_end(
        _timed_messages(spark, sf), "timestamp", lambda m: J.scrape_stream(m, "timestamp", "seconds", "0 seconds", "1 hour"), path, f"{path}.checkpoint", 3600)
    return rounded(spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz")), "value")


@register("stream_scraped_ticks", f"""WITH {_HOURLY_SCRAPES},
  r AS (SELECT application, instance, job, min(ts) AS t0, (SELECT max(ts) FROM s) AS t1 FROM s GROUP BY ALL),
  g AS (SELECT application, instance, job, unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS ts FROM r)
  SELECT application, instance, job, ts, round(last_value(s.value IGNORE NULLS) OVER (PARTITION BY application, instance, job
    ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value FROM g LEFT JOIN s USING (application, instance, job, ts)""")
def stream_scraped_ticks(spark, sf):
    """The same at every hour from a label set's first sample to the end; quiet hours repeat the last value."""
    path = scratch_path(spark, "ticks")
    with TK.rocks_db(spark):
        TK.drain_to_end(
            _timed_messages(spark, sf), "timestamp", lambda m: TK.scrape_ticks(m, "timestamp", "seconds", "0 seconds", 3600), path, f"{path}.checkpoint", 3600)
    return rounded(spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz")), "value")


@register("stream_isolated_errors", """SELECT doc_id AS path, failed, CASE WHEN failed THEN 'frame size ' || n || ' is not 6' END AS error
  FROM (SELECT doc_id, octet_length(encode(lang || source)) AS n, octet_length(encode(lang || source)) <> 6 AS failed FROM documents)""")
def stream_isolated_errors(spark, sf):
    """Good and bad records of a stream in one table, apart; none stops the job."""
    docs = _stream(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.encode(F.concat("lang", "source"), "UTF-8").alias("data"))
    resized = FR.resize_frames(docs, FrameShape(1, 6, 1), 1, 2)
    path = scratch_path(spark, "isolated")
    J.writer(resized, f"{path}.checkpoint", once=True).foreachBatch(J.split_errors(path)).start().awaitTermination()
    return J.read_split(spark, path).select("path", "failed", "error")


def _drained_outcomes(df, path, batches):
    """Runs a stream over all there is through a batch function."""
    J.writer(df, f"{path}.checkpoint", once=True).foreachBatch(batches).start().awaitTermination()


_INGESTED = """raw AS (SELECT doc_id, octet_length(encode(text)) AS n FROM documents),
  cut AS (SELECT doc_id, n, unnest(generate_series(0, greatest((n + 63) // 64 - 1, 0)))::BIGINT AS frame_seq FROM raw),
  frames AS (SELECT doc_id AS video, frame_seq, CASE WHEN n = 0 THEN 'empty container'
    WHEN n - frame_seq * 64 < 64 THEN 'partial frame of ' || (n - frame_seq * 64) || ' bytes' END AS error FROM cut)"""


def _ingested(spark, sf):
    """The ingest job's batches over texts as raw containers: sent messages, errors and counts."""
    containers = _stream(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.encode("text", "UTF-8").alias("content"))
    frames = FR.envelope(J.unfold_outcomes(containers, TEXT_FRAME), TEXT_FRAME, keep=("error",))
    path = scratch_path(spark, "ingested")

    def send(good: DataFrame) -> None:
        KF.as_messages(good).write.mode("append").parquet(f"{path}/sent")

    _drained_outcomes(frames, path, OC.send_outcomes(path, send, ("video", "frame_seq")))
    return path


@register("stream_ingest_errors", f"WITH {_INGESTED} SELECT video, frame_seq, error FROM frames WHERE error IS NOT NULL")
def stream_ingest_errors(spark, sf):
    """The error table of ingest: every frame that was not sent, and why."""
    return OC.read_errors(spark, _ingested(spark, sf))


@register("stream_ingest_counts", f"""WITH {_INGESTED} SELECT count(*)::BIGINT AS rows, count(error)::BIGINT AS failures,
  (count(*) - count(error))::BIGINT AS sent FROM frames""")
def stream_ingest_counts(spark, sf):
    """What the write of ingest counted, and the messages it sent."""
    path = _ingested(spark, sf)
    counts = OC.read_counts(spark, path).agg(F.sum("rows").alias("rows"), F.sum("failures").alias("failures"))
    return counts.crossJoin(spark.read.parquet(f"{path}/sent").agg(F.count(F.lit(1)).alias("sent")))


_FILE_FRAMES = """files AS (SELECT source, hex(encode(string_agg(text || chr(10), '' ORDER BY doc_id))) AS h FROM documents GROUP BY source),
  sized AS (SELECT *, length(h) // 2 AS n FROM files),
  cut AS (SELECT *, unnest(generate_series(0, n // 4096))::BIGINT AS frame_seq FROM sized)"""


@register("stream_sliced_frames", f"""WITH {_FILE_FRAMES} SELECT source, frame_seq,
  CASE WHEN n - frame_seq * 4096 >= 4096 THEN md5(unhex(substr(h, frame_seq * 8192 + 1, 8192))) END AS digest,
  CASE WHEN n - frame_seq * 4096 < 4096 THEN 'partial frame of ' || (n - frame_seq * 4096) || ' bytes' END AS error
  FROM cut WHERE n > frame_seq * 4096 AND (frame_seq = 0 OR floor(frame_seq * 0.4) <> floor((frame_seq - 1) * 0.4) OR n - frame_seq * 4096 < 4096)""")
def stream_sliced_frames(spark, sf):
    """Arriving files of any size: a listing cut into byte ranges that tasks read, thinned from 5 to 2 frames per second.

    The files hold the texts of one source each, a line per document.
    """
    folder = scratch_path(spark, "files")
    texts = V.table(spark, sf, "documents").select("source", "doc_id", "text")
    texts.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text").write.partitionBy("source").text(folder)
    shape = FrameShape(64, 64, 1)
    slices = SF.raw_slices(SF.stream_listing(spark, f"{folder}/*", "part-*"), shape, frames_per_slice=7)
    frames = SF.slice_outcomes(slices, shape, 2 / 5)
    source = F.regexp_extract(F.url_decode("path"), "source=([^/]*)/", 1).alias("source")
    return _drained(spark, frames.select(source, "frame_seq", F.md5("data").alias("digest"), "error"), "sliced")


_MIXED = f"""mixed AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 'frame size 10 is not 64' WHEN vec_id % 11 = 0 THEN 'missing frame' END AS error, data
  FROM ({_SHRINK_SQL}))"""


def _mixed_frames(frames):
    """Frames of which some are cut off and some are missing."""
    damaged = F.when(F.col("vec_id") % 7 == 0, F.substring("data", 1, 10)).when(F.col("vec_id") % 11 != 0, F.col("data"))
    return frames.withColumn("data", damaged)


@register("stream_resize_outcomes", f"""WITH {_MIXED}, n AS (SELECT count(*)::BIGINT AS rows, count(error)::BIGINT AS failures FROM mixed)
  SELECT vec_id::VARCHAR AS key, CASE WHEN error IS NULL THEN data END AS value, error, rows, failures FROM mixed, n""")
def stream_resize_outcomes(spark, sf):
    """The resize job's table: thumbnails and errors apart, and its counts."""
    frames = _mixed_frames(V.frames_from_embeddings(_stream(spark, sf, "embeddings")))
    messages = frames.select(F.col("vec_id").cast("string").cast("binary").alias("key"), F.col("data").alias("value"))
    path = scratch_path(spark, "resize-outcomes")
    _drained_outcomes(IN.resized_outcomes(messages, FrameShape(8, 8, 1), 2, 2), path, OC.keep_outcomes(path))
    both = OC.read_rows(spark, path).unionByName(OC.read_rows(spark, path, failed=True))
    counts = OC.read_counts(spark, path).agg(F.sum("rows").alias("rows"), F.sum("failures").alias("failures"))
    return both.select(F.col("key").cast("string").alias("key"), F.hex("value").alias("value"), "error").crossJoin(counts)


@register("inference_outcomes", f"""WITH {_MIXED}, n AS (SELECT count(*)::BIGINT AS rows, count(error)::BIGINT AS failures FROM mixed)
  SELECT vec_id, error, CASE WHEN error IS NULL THEN data END AS data, error IS NULL AS predicted, rows, failures FROM mixed, n""")
def inference_outcomes(spark, sf):
    """The inference job's table over good and bad frames: a prediction or a message, and the counts."""
    frames, shape = V.frames8(spark, sf), FrameShape(8, 8, 1)
    small = FR.with_features(FR.resize_frames(frames, shape, 2, 2)).withColumn("indexedLabel", F.col("label").cast("double"))
    model = TR.candidates(depths=(2,))[2].pipeline.fit(small)
    path = scratch_path(spark, "scored")
    counts = OC.write_outcomes(IF.score_outcomes(_mixed_frames(frames), model, shape, 2, 2), path)
    scored = spark.read.parquet(path).select("vec_id", "error", F.hex("data").alias("data"), F.col("prediction").isNotNull().alias("predicted"))
    return scored.withColumns({"rows": F.lit(counts[0]).cast("long"), "failures": F.lit(counts[1]).cast("long")})


@register("stream_union", """SELECT 'orders' AS producer, o_orderkey AS id, o_totalprice AS value FROM orders
  UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer""")
def stream_union(spark, sf):
    """Streams of several producers merged into one."""
    orders = _stream(spark, sf, "orders").select(F.lit("orders").alias("producer"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"))
    customers = _stream(spark, sf, "customer").select(F.lit("customer").alias("producer"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"))
    return _drained(spark, J.merge_streams(orders, customers), "merged")


@register("stream_deduplicated", "SELECT DISTINCT 'video_' || (event_id % 10) AS video, event_id // 20 AS frame_seq FROM events")
def stream_deduplicated(spark, sf):
    """Copies that an at-least-once sink may write are dropped by frame key."""
    events = _stream(spark, sf, "events")
    sent = events.select(
        F.concat(F.lit("video_"), F.col("event_id") % 10).alias("video"), F.floor(F.col("event_id") / 20).alias("frame_seq"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.encode("props", "UTF-8").alias("data"),
    )
    messages = KF.as_messages(sent, extra=("timestamp",))
    once = KF.drop_repeated(KF.from_messages(messages), "31 days")
    return _drained(spark, once.select("video", "frame_seq"), "deduplicated")


@register("stream_resized_once", f"""WITH {_MIXED} SELECT 'v' || (vec_id % 3) || '/' || vec_id AS key, CASE WHEN error IS NULL THEN data END AS value, error FROM mixed""")
def stream_resized_once(spark, sf):
    """The resize job over a topic that holds every frame three times, in several batches: one thumbnail or error each."""
    frames = _mixed_frames(V.frames8(spark, sf))
    key = F.concat(F.lit("v"), F.col("vec_id") % 3, F.lit("/"), F.col("vec_id")).cast("binary").alias("key")
    sent = frames.select(key, F.col("data").alias("value"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy"))
    topic = scratch_path(spark, "topic")
    sent.repartition(5, "copy", "key").select("key", "value").write.parquet(topic)
    stream = spark.readStream.schema(spark.read.parquet(topic).schema).option("maxFilesPerTrigger", 2).parquet(topic)
    with TK.rocks_db(spark):
        once = _drained(spark, IN.resized_once(stream, FrameShape(8, 8, 1), 2, 2), "once")
    return once.select(F.col("key").cast("string").alias("key"), F.hex("value").alias("value"), "error")


# --------------------------------------------------------------------------
# Training-data operators, if they are there
# --------------------------------------------------------------------------

try:
    import corpus_pipeline as _pipeline
    from reelmetry.llm import queries as _llm
except ImportError as missing:
    # Only the absence of these modules themselves counts, not a fault inside them.
    if missing.name not in ("corpus_pipeline", "reelmetry.llm", "reelmetry.llm.queries"):
        raise
else:
    _QUERIES.update(_llm.queries())
    _QUERIES["pipeline"] = _pipeline.run
    _SQL.update(_llm.oracle_sql())
    if _pipeline.ORACLE_SQL:
        _SQL["pipeline"] = _pipeline.ORACLE_SQL


# --------------------------------------------------------------------------
# Contract
# --------------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Per-producer statistics at the smallest scale."""
    return producer_statistics(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
