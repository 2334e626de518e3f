"""Operational metrics from per-message events: counters, gauges, histograms.

Each function is a plain grouping with map-side combining, so it runs on tables
and, unchanged, on streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.functions.text import scrape_labels
from reelmetry.functions.times import lag_seconds
from reelmetry.operators.ordered import TARGET_ROWS, cut_regular, last_known, running_total
from reelmetry.schemas import DEFAULT_BUCKETS
from reelmetry.session import spread_count

LABELS = ["application", "instance", "job"]


def with_scrape_labels(df: DataFrame, address: str = "address") -> DataFrame:
    return df.withColumns(scrape_labels(F.col(address)))


def measure_messages(messages: DataFrame, now: Column) -> DataFrame:
    """Per message: payload size and lag behind ``now`` in seconds."""
    return messages.withColumns({
        "lag_seconds": lag_seconds(F.col("timestamp"), now),
        "size_bytes": F.octet_length("value"),
    })


def counters(events: DataFrame, conditions: Mapping[str, Column], labels: Sequence[str] = LABELS) -> DataFrame:
    """One counter per condition: how many rows fulfil it, by label set."""
    return events.groupBy(*labels).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def producer_counters(frames: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Counters of an ingest job, from rows with an ``outcome`` per frame."""
    outcome = F.col("outcome")
    return counters(frames, {
        "frames_produced_total": outcome.isin("ok", "sink_error"),
        "frame_production_errors_total": outcome == "frame_error",
        "producer_errors_total": outcome == "sink_error",
        "read_errors_total": outcome == "read_error",
    }, labels)


def consumer_counters(messages: DataFrame, failed: Column, labels: Sequence[str] = LABELS) -> DataFrame:
    """Counters of the consumer; a failed message was consumed, too."""
    return counters(messages, {
        "messages_consumed_total": F.lit(True), "message_consumption_errors_total": failed,
    }, labels)


def gauges(samples: DataFrame, values: Sequence[str], order: Column | str, labels: Sequence[str] = LABELS) -> DataFrame:
    """Latest value of each column by label set."""
    return samples.groupBy(*labels).agg(*[F.max_by(v, order).alias(v) for v in values])


def histogram(samples: DataFrame, value: str, bounds: Sequence[float] = DEFAULT_BUCKETS,
              labels: Sequence[str] = LABELS) -> DataFrame:
    """Cumulative bucket counts (``<= le``), total count and sum, one row per bucket."""
    names = [*[str(float(b)) for b in bounds], "+Inf"]
    cells = [F.count_if(F.col(value) <= b) for b in bounds] + [F.count(value)]
    grouped = samples.groupBy(*labels).agg(
        *[c.alias(f"_b{i}") for i, c in enumerate(cells)],
        F.count(value).alias("count"), F.sum(value).alias("sum"),
    )
    entries = [F.struct(F.lit(n).alias("le"), F.col(f"_b{i}").alias("bucket")) for i, n in enumerate(names)]
    return grouped.select(*labels, F.explode(F.array(*entries)).alias("e"), "count", "sum").select(
        *labels, "e.le", "e.bucket", "count", "sum"
    )


def scrape(samples: DataFrame, ts: str, value: str, interval: str = "2 seconds",
           labels: Sequence[str] = LABELS, order: Column | None = None) -> DataFrame:
    """Gauge samples on a fixed clock: the last value set before each scrape."""
    order = F.col(ts) if order is None else order
    grouped = samples.groupBy(F.window(ts, interval).alias("w"), *labels).agg(F.max_by(value, order).alias("value"))
    return grouped.select(*labels, F.col("w.end").alias("ts"), "value")


def _micros(interval_seconds: float) -> int:
    return round(interval_seconds * 1_000_000)


def scrape_grid(scraped: DataFrame, interval_seconds: float, labels: Sequence[str] = LABELS,
                target_rows: int = TARGET_ROWS, block: int = 100_000) -> DataFrame:
    """Scrapes also for quiet intervals, which repeat the last value.

    The grid is generated in two steps, block numbers first and then the ticks
    of a block, so that a long series does not unfold in one task.
    """
    labels = list(labels)
    width = F.lit(_micros(interval_seconds))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = scraped.groupBy(*labels).agg(F.min(at).alias("_from"), F.max(at).alias("_to"))
    steps = ((F.col("_to") - F.col("_from")) / width).cast("long")
    sized = bounds.withColumn("_steps", steps)
    # The rows are few and small: without a number, adaptive execution would merge them into one task.
    blocks = sized.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_steps") / block).cast("long")))
    ).repartition(spread_count(scraped.sparkSession, 1 << 30), *labels, "_block")
    last = F.least(F.col("_steps"), (F.col("_block") + 1) * block - 1)
    ticks = blocks.withColumn("_step", F.explode(F.sequence(F.col("_block") * block, last))).select(
        *labels, "_step", (F.col("_from") + F.col("_step") * width).alias("_at")
    )
    known = scraped.select(*labels, at.alias("_at"), "value")
    grid = ticks.join(known, [*labels, "_at"], "left")
    filled = cut_regular(grid, labels, "_at", F.col("_step"), target_rows).run(last_known("value", "value")).result()
    return filled.select(*labels, F.timestamp_micros("_at").cast("timestamp_ntz").alias("ts"), "value")


def scrape_counter(events: DataFrame, ts: str, interval_seconds: float, labels: Sequence[str] = LABELS,
                   target_rows: int = TARGET_ROWS) -> DataFrame:
    """A counter's cumulative value at each scrape that saw an increment.

    Events are first counted per interval, so the running total works on one
    row per (label set, interval).
    """
    labels = list(labels)
    width = _micros(interval_seconds)
    tick = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / width).cast("long")
    per_tick = events.groupBy(*labels, tick.alias("_tick")).agg(F.count("*").alias("increase"))
    total = cut_regular(per_tick, labels, "_tick", F.col("_tick"), target_rows).run(running_total("increase", "value"))
    at = F.timestamp_micros((F.col("_tick") + 1) * width).cast("timestamp_ntz")
    return total.result().select(*labels, at.alias("ts"), "increase", "value")
