"""Bottleneck, efficiency and correlation analysis of the aligned series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetry.operators.correlate import correlation_matrix
from reelmetry.operators.decompose import decompose, decompose_wide
from reelmetry.operators.ordered import TARGET_ROWS
from reelmetry.operators.quantiles import exact_quantile
from reelmetry.operators.series import missing_metrics, wide_table
from reelmetry.operators.skew import attach_small, few_groups, rows_within, store
from reelmetry.schemas import CORRELATED_METRICS

# --- fixed values: thresholds and texts of the bottleneck report ---
CPU_LIMIT = 90
MEMORY_QUANTILE = 0.9
HIGH_CPU = "High CPU (>90%)"
HIGH_MEMORY = "High Memory (top 10%)"
RATIO_GUARD = 0.01


def with_totals(wide: DataFrame) -> DataFrame:
    return wide.withColumns({
        "network_total": F.col("Network_received") + F.col("Network_sent"),
        "disk_total": F.col("Disk_read") + F.col("Disk_write"),
    })


def bottleneck_pairs(wide: DataFrame) -> DataFrame:
    """The four (x, y) point sets behind the bottleneck charts, as a long table."""
    pairs = [
        ("CPU vs Throughput", "CPU", "Throughput"),
        ("Memory vs Latency", "Memory", "Avg_latency"),
        ("Network I/O vs Frame Production", "network_total", "Frame_prod"),
        ("Disk I/O vs Consumption Time", "disk_total", "Msg_cons_time"),
    ]
    points = [F.struct(F.lit(t).alias("pair"), F.col(x).alias("x"), F.col(y).alias("y")) for t, x, y in pairs]
    return with_totals(wide).select("producer", "ts", F.explode(F.array(*points)).alias("p")).select(
        "producer", "ts", "p.*"
    )


def stored_wide_table(samples: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """The aligned table, written once for the analyses that read it."""
    return store(wide_table(samples, target_rows=target_rows), "wide")


def bottlenecks(wide: DataFrame, target_rows: int = TARGET_ROWS, bound: DataFrame | None = None) -> DataFrame:
    """Per producer: peaks, the memory threshold and the list of findings.

    ``bound``: the samples behind ``wide``, cheaper to count.
    """
    peaks = wide.groupBy("producer").agg(F.max("CPU").alias("max_cpu"), F.max("Memory").alias("max_memory"))
    threshold = exact_quantile(wide, ["producer"], "Memory", MEMORY_QUANTILE, "memory_q90", target_rows, bound)
    found = F.array_compact(F.array(
        F.when(F.col("max_cpu") > CPU_LIMIT, F.lit(HIGH_CPU)),
        F.when(F.col("max_memory") > F.col("memory_q90"), F.lit(HIGH_MEMORY)),
    ))
    return peaks.join(threshold, "producer").withColumn("bottlenecks", found)


def efficiency_ratios(wide: DataFrame) -> DataFrame:
    return wide.withColumns({
        "frames_per_cpu": F.col("Frame_prod") / (F.col("CPU") + RATIO_GUARD),
        "frames_per_mem": F.col("Frame_prod") / (F.col("Memory") + RATIO_GUARD),
    })


def resource_efficiency(wide: DataFrame) -> DataFrame:
    return efficiency_ratios(wide).groupBy("producer").agg(
        F.avg("frames_per_cpu").alias("avg_cpu_efficiency"),
        F.avg("frames_per_mem").alias("avg_mem_efficiency"),
    )


def flag_anomalies(samples: DataFrame, metric: str = "Throughput", sigmas: float = 3.0, period: int = 30,
                   target_rows: int = TARGET_ROWS) -> DataFrame:
    """Optional extra: residuals beyond ``sigmas`` standard deviations per producer."""
    decomposed = decompose(samples, metric, period, target_rows)
    if not rows_within(samples, target_rows):
        decomposed = store(decomposed, "decomposed")
    spread = decomposed.groupBy("producer").agg(F.stddev_pop("resid").alias("spread"))
    fits = few_groups(samples, ["producer"])
    joined = attach_small(decomposed, spread, ["producer"], fits=fits, spread_by="pos")
    beyond = F.abs("resid") > sigmas * F.col("spread")
    return joined.withColumn("anomaly", F.coalesce(beyond, F.lit(False))).drop("spread")


def full_report(samples: DataFrame, target_rows: int = TARGET_ROWS) -> dict[str, DataFrame]:
    """All analyses of all producers, as lazy tables over one stored aligned table."""
    wide = stored_wide_table(samples, target_rows)
    return {
        "correlations": correlation_matrix(wide, CORRELATED_METRICS),
        "decomposition": decompose_wide(wide, "Throughput", target_rows=target_rows),
        "bottlenecks": bottlenecks(wide, target_rows),
        "efficiency": resource_efficiency(wide),
        "missing_metrics": missing_metrics(samples),
    }


def analysis_summary(samples: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """One printed-report row per producer: heading name, findings and efficiency."""
    wide = stored_wide_table(samples, target_rows)
    return (
        bottlenecks(wide, target_rows)
        .join(resource_efficiency(wide), "producer")
        .join(missing_metrics(samples), "producer")
        .withColumn("heading", F.concat(F.lit("ANALYZING: "), F.upper("producer")))
        .withColumn("findings", F.when(F.size("bottlenecks") > 0, F.array_join("bottlenecks", "; ")).otherwise("None"))
    )
