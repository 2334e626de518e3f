"""Scrapes of a stream on a fixed clock, quiet intervals and the last one included, and inputs that end."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from reelmetry.operators.counters import LABELS
from reelmetry.streaming.jobs import writer

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Ticks(StatefulProcessor):
    """One label set's gauge: its value at every tick of the clock.

    State are the values of the ticks that the watermark has not passed (a few, as
    many as the lateness allows) and the last tick that was emitted with its value.
    One timer is set at a time, for the next tick; when it fires, every tick up to
    the watermark comes out at once, quiet ones with the value before them.
    """

    def __init__(self, width_ms: int, labels: Sequence[str], ts: str, value: str) -> None:
        self.width, self.labels, self.ts, self.value = width_ms, list(labels), ts, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "tick long", "at long, value double")
        self.last = handle.getValueState("last", "tick long, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        least = None
        for part in rows:
            part = part[part[self.ts].notna() & part[self.value].notna()]
            if part.empty:
                continue
            at = part[self.ts].to_numpy().astype("datetime64[us]").astype("int64")
            found = pd.DataFrame({"tick": (at // (self.width * 1000) + 1) * self.width, "at": at, "value": part[self.value].to_numpy()})
            for tick, when, value in found.sort_values(["at", "value"]).groupby("tick").last().itertuples():
                known = self.open.getValue((tick,)) if self.open.containsKey((tick,)) else None
                if known is None or (when, value) > tuple(known):
                    self.open.updateValue((tick,), (int(when), float(value)))
                least = tick if least is None else min(least, tick)
        if least is not None and not self.last.exists():
            self.handle.registerTimer(int(least))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() // self.width * self.width
        known = {tick: value for (tick,), (_, value) in self.open.iterator() if tick <= until}
        tick, value = self.last.get() if self.last.exists() else (min(known, default=until) - self.width, None)
        if tick >= until:
            return
        ticks, values = [], []
        for tick in range(tick + self.width, until + 1, self.width):
            value = known.get(tick, value)
            ticks.append(tick)
            values.append(value)
        for tick in known:
            self.open.removeKey((tick,))
        self.last.update((until, value))
        self.handle.registerTimer(until + self.width)
        yield pd.DataFrame({**{name: [part] * len(ticks) for name, part in zip(self.labels, key, strict=True)}, "ts": pd.to_datetime(ticks, unit="ms"), "value": values})

    def close(self) -> None:
        pass


@contextmanager
def rocks_db(spark: SparkSession) -> Iterator[None]:
    """State processors need this state store; the session's own setting comes back afterwards."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def scrape_ticks(samples: DataFrame, ts: str, value: str, delay: str, interval_seconds: int = 2, labels: Sequence[str] = tuple(LABELS)) -> DataFrame:
    """A stream's gauge by label set at every tick from its first sample on: the last value set before the tick.

    A quiet tick repeats the value before. A tick comes out when the watermark
    (``delay`` behind the newest sample) has passed it; ``drain_to_end`` brings the
    last ones. Samples of one tick are ordered by time, equal times by value; null
    times and values are no samples. Needs ``rocks_db`` when it is started.
    """
    kinds = [T.StructField(name, samples.schema[name].dataType) for name in labels]
    schema = T.StructType([*kinds, T.StructField("ts", T.TimestampType()), T.StructField("value", T.DoubleType())])
    timed = samples.select(*labels, F.col(ts).cast("timestamp").alias(ts), F.col(value).cast("double").alias(value)).withWatermark(ts, delay)
    processor = Ticks(interval_seconds * 1000, labels, ts, value)
    return timed.groupBy(*labels).transformWithStateInPandas(processor, schema, "append", "EventTime")


def drain_to_end(samples: DataFrame, ts: str, scraped: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, interval_seconds: int, delay_seconds: int = 0) -> None:
    """Runs ``scraped`` over all available samples into a file table and closes the input.

    The watermark alone never passes the newest sample, so the ticks after it would
    stay in the state. A second source beside the samples is empty until they are
    drained; then it gets one row whose time is the end of the newest sample's tick
    (and the delay), all else null. The query goes on from its checkpoint, the row
    moves the watermark, and windows and timers up to the end fire. The row itself
    makes no result. What arrives after the end is late.
    """
    spark = samples.sparkSession
    ends = f"{path.rstrip('/')}.end"
    spark.createDataFrame([], samples.schema).write.mode("append").parquet(ends)
    both = samples.unionByName(spark.readStream.schema(samples.schema).parquet(ends))

    def run():
        query = writer(scraped(both), checkpoint, once=True).format("parquet").start(path)
        query.awaitTermination()
        return [p.eventTime["watermark"] for p in query.recentProgress if "watermark" in p.eventTime]

    marks = run()
    reached = max((datetime.fromisoformat(m).astimezone(timezone.utc).timestamp() for m in marks), default=0.0)
    if reached <= 0:
        return
    newest = reached + delay_seconds
    end = (newest // interval_seconds + 1) * interval_seconds + delay_seconds
    row = spark.range(1).select(*[
        (F.timestamp_seconds(F.lit(end)) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in samples.schema.fields])
    row.write.mode("append").parquet(ends)
    run()
