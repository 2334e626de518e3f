"""Streaming jobs: ingest, resize, consume, scrape, and a bounded restart."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from reelmetry.operators.counters import LABELS, scrape
from reelmetry.operators.frames import Decoder, decode_frames, resize_frames, split_raw, split_raw_outcomes
from reelmetry.schemas import FrameShape

# --- fixed values: restart strategy and poll interval ---
RESTART_ATTEMPTS = 3
RESTART_DELAY_SECONDS = 10.0
POLL_INTERVAL = "5 seconds"


def unfold_videos(videos: DataFrame, shape: FrameShape = FrameShape(), decoder: Decoder | None = None,
                  tasks: int | None = None) -> DataFrame:
    """Frames of arriving video files; ``tasks`` spreads the files of a batch."""
    spread = videos.repartition(tasks, "path") if tasks else videos
    return decode_frames(spread, decoder) if decoder else split_raw(spread, shape)


def with_empty_errors(frames: DataFrame) -> DataFrame:
    """Frames without a byte get a message as well."""
    empty = F.octet_length("data") == 0
    return frames.withColumn("error", F.when(F.col("error").isNull() & empty, "empty frame").otherwise(F.col("error")))


def unfold_outcomes(videos: DataFrame, shape: FrameShape = FrameShape(), decoder: Decoder | None = None,
                    tasks: int | None = None) -> DataFrame:
    """``unfold_videos`` with ``error``: frames that did not convert, partial and empty ones are rows with a message."""
    spread = videos.repartition(tasks, "path") if tasks else videos
    return with_empty_errors(decode_frames(spread, decoder)) if decoder else split_raw_outcomes(spread, shape)


def resize_stream(frames: DataFrame, shape: FrameShape = FrameShape(), height: int = 64, width: int = 64) -> DataFrame:
    return resize_frames(frames, shape, height, width)


def merge_streams(*streams: DataFrame) -> DataFrame:
    """Several producers' streams as one."""
    first, *rest = streams
    for other in rest:
        first = first.unionByName(other)
    return first


def scrape_stream(samples: DataFrame, ts: str, value: str, delay: str, interval: str = "2 seconds",
                  labels=tuple(LABELS), order: Column | None = None) -> DataFrame:
    """Fixed-clock gauge samples of a stream; rows later than ``delay`` are late."""
    return scrape(samples.withWatermark(ts, delay), ts, value, interval, labels, order)


def write_batch_once(df: DataFrame, batch_id: int, path: str) -> None:
    """Write a micro-batch under its own number: a replay overwrites, never adds."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def split_errors(path: str, error: str = "error") -> Callable[[DataFrame, int], None]:
    """Batch function that keeps bad rows apart under ``failed=true``.

    One write computes the rows once; a reader of ``failed = false`` skips the
    bad ones by partition pruning. Bad rows never stop the stream.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = batch.withColumn("failed", F.col(error).isNotNull())
        target = f"{path.rstrip('/')}/batch_id={batch_id}"
        flagged.write.mode("overwrite").partitionBy("failed").parquet(target)

    return write


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """What ``split_errors`` wrote, with ``failed`` as a boolean again."""
    return spark.read.parquet(path).withColumn("failed", F.col("failed").cast("boolean")).drop("batch_id")


def replace_table(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for complete mode: the table is the latest full result."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write


def writer(df: DataFrame, checkpoint: str, *, mode: str = "append", once: bool = False,
           every: str = POLL_INTERVAL) -> DataStreamWriter:
    """Writer with a checkpoint; ``once`` drains what is there and stops."""
    started = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return started.trigger(availableNow=True) if once else started.trigger(processingTime=every)


def drain_to_table(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over all available input into an exactly-once file table."""
    writer(df, checkpoint, once=True).format("parquet").start(path).awaitTermination()


def run_with_restarts(start: Callable[[], StreamingQuery], attempts: int = RESTART_ATTEMPTS,
                      delay_seconds: float = RESTART_DELAY_SECONDS,
                      sleep: Callable[[float], None] = time.sleep) -> int:
    """Run a query to its end, restarting it from its checkpoint when it fails.

    Returns the number of restarts; the failure after the last one is raised.
    """
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException:
            if restarts == attempts:
                raise
            restarts += 1
            sleep(delay_seconds)
