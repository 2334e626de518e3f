"""The streaming jobs between topics: ingest, resize, consume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelmetry.operators.counters import LABELS, measure_messages
from reelmetry.operators.frames import Decoder, decode_frames, drop_empty, envelope, resample_constant
from reelmetry.schemas import FrameShape, IngestConfig
from reelmetry.sources import kafka
from reelmetry.sources.files import VIDEO_GLOB, raw_slices, slice_outcomes, stream_listing, stream_videos
from reelmetry.streaming.copies import first_copies
from reelmetry.streaming.jobs import resize_stream, unfold_videos, with_empty_errors, writer
from reelmetry.streaming.outcomes import keep_outcomes, send_outcomes
from reelmetry.streaming.ticks import rocks_db
from reelmetry.streaming.totals import add_to_totals, consumption_summary


def video_frames(spark: SparkSession, config: IngestConfig, decoder: Decoder | None = None,
                 tasks: int | None = None, glob: str = VIDEO_GLOB) -> DataFrame:
    """Frames of the videos that arrive in the folder, in their envelope."""
    frames = unfold_videos(stream_videos(spark, config.video_path, glob), config.frame, decoder, tasks)
    return drop_empty(envelope(frames, config.frame, rate=config.frame_rate))


def video_outcomes(spark: SparkSession, config: IngestConfig, decoder: Decoder | None = None,
                   tasks: int | None = None, glob: str = VIDEO_GLOB, frames_per_slice: int = 512) -> DataFrame:
    """Frames of arriving videos of any size in their envelope, the bad ones with a message in ``error`` and no data.

    The stream is a listing without content. Raw containers are cut into byte ranges
    that many tasks read, encoded ones are opened in the tasks. If the files'
    rate is known, one frame per tick of ``frame_rate`` is kept, in the same pass:
    of raw files the others are not even read.
    """
    files = stream_listing(spark, config.video_path, glob)
    thinned = config.source_rate is not None and config.source_rate > config.frame_rate
    if decoder is None:
        slices = raw_slices(files, config.frame, frames_per_slice)
        frames = slice_outcomes(slices, config.frame, config.frame_rate / config.source_rate if thinned else None, tasks)
    else:
        spread = files.repartition(tasks, "path") if tasks else files
        frames = with_empty_errors(decode_frames(spread, decoder, open_in_task=True))
        frames = resample_constant(frames, config.source_rate, config.frame_rate) if thinned else frames
    return envelope(frames, config.frame, rate=config.source_rate or config.frame_rate, keep=("error",))


def to_topic(options: dict[str, str]) -> Callable[[DataFrame], None]:
    """Sends messages (key, value) to a topic."""
    return lambda messages: messages.write.format("kafka").options(**options).save()


def ingest(spark: SparkSession, config: IngestConfig, checkpoint: str, table: str, decoder: Decoder | None = None, tasks: int | None = None,
           send: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Videos to frame messages; ``table`` gets the errors and the counts of every batch."""
    send = send or to_topic(kafka.sink_options(config.bootstrap_servers, config.topic))
    batches = send_outcomes(table, lambda frames: send(kafka.as_messages(frames)), ("video", "frame_seq"))
    return writer(video_outcomes(spark, config, decoder, tasks), checkpoint).foreachBatch(batches).start()


def resized_outcomes(messages: DataFrame, shape: FrameShape = FrameShape(), height: int = 64, width: int = 64) -> DataFrame:
    """Frame messages with the thumbnail as value; the key is passed on, a bad frame has no value and a message in ``error``."""
    resized = resize_stream(messages.select("key", F.col("value").alias("data")), shape, height, width)
    return resized.select("key", F.col("data").alias("value"), "error")


def resized_once(messages: DataFrame, shape: FrameShape = FrameShape(), height: int = 64, width: int = 64) -> DataFrame:
    """``resized_outcomes`` without the copies that an at-least-once topic may hold; messages without a frame key all stay."""
    named = resized_outcomes(messages, shape, height, width)
    key = F.decode(F.col("key"), "UTF-8")
    found = named.withColumns({
        "video": F.regexp_extract(key, kafka.FRAME_KEY, 1), "frame_seq": F.nullif(F.regexp_extract(key, kafka.FRAME_KEY, 2), F.lit("")).cast("long")})
    return first_copies(found).select("key", "value", "error")


def resized_messages(messages: DataFrame, shape: FrameShape = FrameShape(), height: int = 64, width: int = 64) -> DataFrame:
    """The messages of the good frames alone; the job keeps the bad ones as well."""
    return resized_outcomes(messages, shape, height, width).filter("error is null").drop("error")


def resize(spark: SparkSession, servers: str, checkpoint: str, table: str, source: str = kafka.FRAME_TOPIC,
           target: str = kafka.PROCESSED_TOPIC, min_partitions: int | None = None, records_per_batch: int | None = None) -> StreamingQuery:
    """Frame topic to thumbnail topic; a batch takes all there is unless ``records_per_batch`` says less.

    ``table`` gets thumbnails and errors apart, and the counts; what is sent is read
    from there. A frame that the source topic holds several times is sent once.
    """
    read = kafka.source_options(servers, source, starting="earliest", per_trigger=records_per_batch,
                                min_partitions=min_partitions)
    send = to_topic(kafka.sink_options(servers, target))
    batches = keep_outcomes(table, lambda rows: send(rows.select("key", "value")))
    with rocks_db(spark):
        return writer(resized_once(kafka.read_stream(spark, read)), checkpoint).foreachBatch(batches).start()


def consumer_totals(messages: DataFrame, now: Column, application: str = "kafka-service",
                    instance: str = "kafka-service:9091") -> DataFrame:
    """Messages, bytes, missing payloads and latest lag of the consumer."""
    labels = {"application": application, "instance": instance, "job": application}
    measured = measure_messages(messages, now).withColumns({k: F.lit(v) for k, v in labels.items()})
    return measured.groupBy(*LABELS).agg(
        F.count("*").alias("messages_consumed_total"),
        F.count_if(F.col("value").isNull()).alias("message_consumption_errors_total"),
        F.sum("size_bytes").alias("bytes_total"),
        F.max_by("lag_seconds", "timestamp").alias("consumer_lag_seconds"),
    )


def consumer_summary(messages: DataFrame, now: Column, application: str = "kafka-service", instance: str = "kafka-service:9091") -> DataFrame:
    """A batch of messages as a summary that adds up: counts, bytes, missing payloads, and lag as latest value and histogram."""
    labels = {"application": application, "instance": instance, "job": application}
    measured = measure_messages(messages, now).withColumns({k: F.lit(v) for k, v in labels.items()})
    return consumption_summary(measured, "lag_seconds", F.col("value").isNull(), latest=("lag_seconds",))


def consume(spark: SparkSession, servers: str, out: str, checkpoint: str,
            topic: str = kafka.FRAME_TOPIC) -> StreamingQuery:
    """Consumer metrics of a topic, from its latest offset on; ``totals.read_totals`` reads them."""
    options = kafka.source_options(servers, topic, group_prefix="video-consumer", tuned_fetch=True)
    batches = add_to_totals(out, lambda batch: consumer_summary(batch, F.current_timestamp()))
    return writer(kafka.read_stream(spark, options), checkpoint).foreachBatch(batches).start()
