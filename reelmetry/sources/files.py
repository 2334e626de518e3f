"""File sources: videos, images, labelled lists, metric files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmetry.functions.text import SERIES_PATH, base_name, is_video_name, parent_name
from reelmetry.functions.times import parse_sample_time
from reelmetry.operators.labels import parse_image_list
from reelmetry.operators.series import ordered_files
from reelmetry.operators.skew import BROADCAST_ROWS, rows_within
from reelmetry.schemas import IMAGE_LIST_SCHEMA, METRIC_CSV_SCHEMA, METRICS, FrameShape
from reelmetry.session import spread_count
from reelmetry.sources.slices import outcome_reader, slice_reader

# --- fixed values: file name patterns ---
VIDEO_GLOB = "video_[0-9][0-9].mp4"
MP4_GLOB = "*.mp4"
IMAGE_GLOB = "*.JPG"

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


def read_binary(spark: SparkSession, folder: str, glob: str = MP4_GLOB) -> DataFrame:
    """Files as path, modificationTime, length, content; unused content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def list_videos(spark: SparkSession, folder: str, glob: str = VIDEO_GLOB) -> DataFrame:
    """Video files by name, without their content.

    Spark's file scan passes over files of 0 bytes, which hold no frame.
    """
    files = read_binary(spark, folder, glob).select("path", "length", base_name(F.col("path")).alias("name"))
    return files.filter(is_video_name(F.col("name"))).orderBy("name")


def read_videos(spark: SparkSession, folder: str, tasks: int | None = None, glob: str = VIDEO_GLOB) -> DataFrame:
    """Video files with content, optionally spread over ``tasks`` by file."""
    files = read_binary(spark, folder, glob)
    return files.repartition(tasks, "path") if tasks else files


def stream_videos(spark: SparkSession, folder: str, glob: str = VIDEO_GLOB, files_per_batch: int | None = None) -> DataFrame:
    """New video files as they appear; each file once per checkpoint, all that are there in a batch unless ``files_per_batch`` says less."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(folder)


def read_image_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(IMAGE_LIST_SCHEMA).option("header", True).csv(path)


def read_label_texts(spark: SparkSession, paths: Sequence[str], base_path: str) -> DataFrame:
    """Label text files, all rows of all files; malformed lines in ``corrupt``."""
    return parse_image_list(spark.read.text(list(paths)), base_path)


def read_images(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Decoded images: path and the BGR image struct; unreadable ones have height -1."""
    reader = spark.read.format("image")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("image.origin").alias("path"), "image")


def bare_path(path: Column) -> Column:
    """Path without scheme and authority, for matching file names from two sources."""
    return F.regexp_replace(path, r"^[a-z0-9]+:(//[^/]*)?(?=/)", "")


def lookup_images(listed: DataFrame, images: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """List rows with the payload of their image; rows without an image drop out.

    The join is on the path. A list of checked size is broadcast, so the large
    payload stays where it was read; a longer list shuffles both sides by path.
    """
    left = listed.withColumn("_path", bare_path(F.col("image_path")))
    right = images.withColumn("_path", bare_path(F.col("path"))).drop("path")
    if rows_within(listed, limit):
        left = F.broadcast(left)
    else:
        left = left.hint("merge")
    return right.join(left, "_path").drop("_path")


def unmatched_images(listed: DataFrame, images: DataFrame) -> DataFrame:
    """List rows whose image is missing or unreadable."""
    good = images.select(bare_path(F.col("path")).alias("_path")).distinct()
    return listed.withColumn("_path", bare_path(F.col("image_path"))).join(good, "_path", "left_anti").drop("_path")


def image_sequence(spark: SparkSession, folder: str, rate: float = 1.0, glob: str = IMAGE_GLOB) -> DataFrame:
    """An image folder as a frame sequence: images by name, one per ``1/rate`` seconds.

    Names are numbered first, without content; the images meet their number in
    a join on the path.
    """
    listing = read_binary(spark, folder, glob).select(
        "path", parent_name(F.col("path")).alias("folder"), base_name(F.col("path")).alias("name")
    )
    numbered = ordered_files(listing).select(bare_path(F.col("path")).alias("_path"), "folder", "name", "frame_seq")
    if rows_within(listing, BROADCAST_ROWS):
        numbered = F.broadcast(numbered)
    images = read_images(spark, folder, glob).withColumn("_path", bare_path(F.col("path")))
    at = F.timestamp_micros((F.col("frame_seq") * (1_000_000 / rate)).cast("long")).cast("timestamp_ntz")
    return images.join(numbered, "_path").drop("_path").withColumn("ts", at)


def series_of_path(df: DataFrame, path: str) -> DataFrame:
    """Add producer (folder) and metric (file stem) of ``<producer>/<metric>.csv``."""
    return df.withColumns({
        "producer": F.regexp_extract(path, SERIES_PATH, 1),
        "metric": F.regexp_extract(path, SERIES_PATH, 2),
    })


def read_metric_files(spark: SparkSession, base: str, skip_unreadable: bool = False) -> DataFrame:
    """All ``<base>/<producer>/<metric>.csv`` files as one long table.

    ``seq`` increases in file order: a split's byte offset plus the row number
    in its task. A row takes more than one byte, so a task never counts as many
    rows as the bytes between two splits of a file. ``time_text`` is the raw
    timestamp; an unreadable value or ``NaN`` is null and its row stays. An unreadable
    file stops the job, or with ``skip_unreadable`` is passed over; a series
    without rows then shows in ``missing_files``.
    """
    reader = spark.read.schema(METRIC_CSV_SCHEMA).option("mode", "PERMISSIVE")
    reader = reader.option("ignoreCorruptFiles", skip_unreadable).option("ignoreMissingFiles", skip_unreadable)
    rows = reader.csv(f"{base.rstrip('/')}/*/*.csv")
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    located = rows.select(
        "*", (F.col("_metadata.file_block_start") + row_in_task).alias("seq"), F.col("_metadata.file_path").alias("_p")
    )
    return series_of_path(located, "_p").select(
        "producer", "metric", F.col("timestamp").alias("time_text"),
        parse_sample_time(F.col("timestamp")).alias("ts"), F.when(~F.isnan("value"), F.col("value")).alias("value"), "seq",
    )


def missing_files(samples: DataFrame, metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """Expected (producer, metric) pairs that have no rows."""
    present = samples.select("producer", "metric").distinct()
    expected = present.select("producer").distinct().select(
        "producer", F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric")
    )
    return expected.join(present, ["producer", "metric"], "left_anti")


def producers(samples: DataFrame) -> DataFrame:
    """Producers that have at least one usable sample."""
    return samples.filter(F.col("ts").isNotNull()).select("producer").distinct()


def raw_file_frames(spark: SparkSession, folder: str, shape: FrameShape = FrameShape(), glob: str = MP4_GLOB,
                    frames_per_slice: int = 512) -> DataFrame:
    """Frames of raw containers of any size, read slice by slice.

    ``binaryFile`` takes a file as one row of at most 2 GB. Here only the
    listing is a table; it is cut into slices of ``frames_per_slice`` frames,
    the slices are spread over the tasks, and a task opens the file and reads
    its own byte range. One huge file is thus read by many tasks.
    """
    size = shape.nbytes
    listing = read_binary(spark, folder, glob).select("path", F.floor(F.col("length") / size).alias("_frames"))
    slices = listing.filter("_frames > 0").select(
        "path", "_frames",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_frames") - 1) / frames_per_slice))).alias("_slice"),
    )
    first = F.col("_slice") * frames_per_slice
    ranges = slices.select(
        "path", first.alias("first"), F.least(F.lit(frames_per_slice), F.col("_frames") - first).alias("n")
    )
    # The rows are a few bytes each: without a number, adaptive execution would merge them into one task.
    pieces = listing.agg(F.sum(F.ceil(F.col("_frames") / frames_per_slice))).first()[0] or 1
    ranges = ranges.repartition(spread_count(spark, pieces), "path", "first")
    return ranges.mapInArrow(slice_reader(size), "path string, frame_seq bigint, data binary")


def raw_slices(listing: DataFrame, shape: FrameShape = FrameShape(), frames_per_slice: int = 512) -> DataFrame:
    """Byte ranges of raw containers, batch or stream: ``path``, ``first`` frame, ``n`` frames, ``rest`` bytes after the last one.

    ``listing`` has ``path`` and ``length``; content is never a column, so a file may
    be of any size.
    """
    size = shape.nbytes
    frames, rest = F.floor(F.col("length") / size), F.col("length") % size
    last = F.greatest(F.ceil((F.col("_frames") + (F.col("_rest") > 0).cast("long")) / frames_per_slice) - 1, F.lit(0))
    cut = listing.select("path", frames.alias("_frames"), rest.alias("_rest")).select("*", last.alias("_last")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))).alias("_slice"))
    first = F.col("_slice") * frames_per_slice
    n = F.greatest(F.least(F.lit(frames_per_slice), F.col("_frames") - first), F.lit(0).cast("long"))
    return cut.select(
        "path", F.least(first, F.col("_frames")).alias("first"), n.alias("n"), F.when(F.col("_slice") == F.col("_last"), F.col("_rest")).otherwise(0).alias("rest"))


def slice_outcomes(slices: DataFrame, shape: FrameShape = FrameShape(), ratio: float | None = None, tasks: int | None = None) -> DataFrame:
    """Frames of ``raw_slices``: ``path``, ``frame_seq``, ``data``, ``error``; the slices are spread, each is read where it lands.

    ``ratio``: wanted frames per frame of the file; the others are not read.
    """
    spread = slices.repartition(tasks or spread_count(slices.sparkSession, 1 << 30), "path", "first")
    return spread.mapInArrow(outcome_reader(shape.nbytes, ratio), "path string, frame_seq bigint, data binary, error string")


def stream_listing(spark: SparkSession, folder: str, glob: str = VIDEO_GLOB, files_per_batch: int | None = None) -> DataFrame:
    """New files as they appear, ``path`` and ``length`` only."""
    return stream_videos(spark, folder, glob, files_per_batch).select("path", "length")
