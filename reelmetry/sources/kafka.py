"""Kafka source and sink options, and the frame message format.

The options are built by plain functions, so they can be checked without a
broker; what follows the source is the same for any streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# --- fixed values: consumer and producer settings ---
FETCH_OPTIONS = {
    "kafka.fetch.min.bytes": "100000",
    "kafka.fetch.max.wait.ms": "500",
    "kafka.session.timeout.ms": "10000",
    "kafka.heartbeat.interval.ms": "3000",
    "kafka.request.timeout.ms": "30000",
    "kafka.max.partition.fetch.bytes": "1048576",
}
BATCHING_OPTIONS = {"kafka.linger.ms": "100", "kafka.batch.size": "16384"}
FRAME_TOPIC, PROCESSED_TOPIC = "video-stream", "processed-data"
RECORDS_PER_POLL = 50

#: The key of a frame message: video and frame number.
FRAME_KEY = r"^(.*)/(\d+)$"


def source_options(servers: str, topic: str = FRAME_TOPIC, *, starting: str = "latest",
                   per_trigger: int | None = None, min_partitions: int | None = None,
                   group_prefix: str | None = None, tuned_fetch: bool = False) -> dict[str, str]:
    """Options of a Kafka read; offsets live in the checkpoint, not in the broker."""
    if not servers or not topic:
        raise ValueError("servers and topic must not be empty")
    if starting not in ("latest", "earliest"):
        raise ValueError(f"starting must be latest or earliest, not {starting!r}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    return {**options, **(FETCH_OPTIONS if tuned_fetch else {})}


def sink_options(servers: str, topic: str, *, wait_for_all: bool = True, batching: bool = True) -> dict[str, str]:
    """Options of a Kafka write. The sink is at-least-once; see ``as_messages``."""
    if not servers or not topic:
        raise ValueError("servers and topic must not be empty")
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if wait_for_all:
        options["kafka.acks"] = "all"
    return {**options, **(BATCHING_OPTIONS if batching else {})}


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def write_stream(messages: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """Writer of (key, value) messages to a topic."""
    return messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)


def as_messages(frames: DataFrame, keyed: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Frames as key and value. The key names the frame, so that a reader can
    drop the copies an at-least-once sink may write; unkeyed it is null."""
    key = F.concat_ws("/", "video", F.col("frame_seq").cast("string")).cast("binary")
    key = key if keyed else F.lit(None).cast("binary")
    return frames.select(*extra, key.alias("key"), F.col("data").alias("value"))


def from_messages(messages: DataFrame) -> DataFrame:
    """Frames of keyed messages, with the record time as ``ts``."""
    key = F.decode(F.col("key"), "UTF-8")
    return messages.select(
        F.regexp_extract(key, FRAME_KEY, 1).alias("video"),
        F.nullif(F.regexp_extract(key, FRAME_KEY, 2), F.lit("")).cast("long").alias("frame_seq"),
        F.col("timestamp").alias("ts"), F.col("value").alias("data"),
    )


def drop_repeated(frames: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Each (video, frame_seq) once, for copies at most ``delay`` apart."""
    return frames.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["video", "frame_seq"])
