"""Frame operators: splitting containers, envelopes, rate, features, transformer."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmetry.functions.pixels import gray_frame, resize_frame, signed_values
from reelmetry.operators.skew import keep_listed
from reelmetry.schemas import FRAME_CHANNELS, FRAME_HEIGHT, FRAME_WIDTH, THUMB_HEIGHT, THUMB_WIDTH, FrameShape
from reelmetry.sources.slices import open_path

#: Encoded container (bytes or an open file) to frames; ``None`` stands for a frame
#: that did not convert.
Decoder = Callable[[bytes | BinaryIO], Iterable[bytes | None]]


def split_raw(containers: DataFrame, shape: FrameShape = FrameShape(), content: str = "content",
              keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """One row per frame of containers that are frames back to back.

    Stays in the JVM: the frame numbers are unfolded and each row cuts its own
    slice. Bytes after the last whole frame are no frame; see ``split_leftovers``.
    """
    size = F.lit(shape.nbytes)
    frames = F.floor(F.octet_length(content) / size).cast("int")
    numbers = F.when(frames > 0, F.sequence(F.lit(0), frames - 1)).otherwise(F.array().cast("array<int>"))
    numbered = containers.select(*keep, content, F.explode(numbers).alias("_i"))
    return numbered.select(
        *keep,
        F.col("_i").cast("long").alias("frame_seq"),
        F.substring(F.col(content), F.col("_i") * size + 1, size).alias("data"),
    )


def split_raw_outcomes(containers: DataFrame, shape: FrameShape = FrameShape(), content: str = "content",
                       keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """``split_raw`` with ``error``: bytes after the last whole frame are a row as well, without data, and so is an empty container."""
    size = F.lit(shape.nbytes)
    last = F.greatest(F.ceil(F.octet_length(content) / size).cast("int") - 1, F.lit(0))
    numbered = containers.select(*keep, content, F.explode(F.sequence(F.lit(0), F.coalesce(last, F.lit(0)))).alias("_i"))
    rest = F.least(F.coalesce(F.octet_length(content), F.lit(0)) - F.col("_i") * size, size)
    return numbered.select(
        *keep,
        F.col("_i").cast("long").alias("frame_seq"),
        F.when(rest == size, F.substring(F.col(content), F.col("_i") * size + 1, size)).alias("data"),
        F.when(rest == 0, "empty container").when(rest < size, F.concat(F.lit("partial frame of "), rest, F.lit(" bytes"))).alias("error"),
    )


def split_leftovers(containers: DataFrame, shape: FrameShape = FrameShape(), content: str = "content",
                    keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """Containers that end in a partial frame, a frame error each."""
    rest = (F.octet_length(content) % shape.nbytes).alias("leftover_bytes")
    return containers.select(*keep, rest).filter(F.col("leftover_bytes") > 0)


def decode_frames(containers: DataFrame, decoder: Decoder, content: str = "content", key: str = "path",
                  on_error: str = "null", batch: int = 64, open_in_task: bool = False) -> DataFrame:
    """Frames of encoded containers, through a decoder that runs in the tasks.

    ``on_error``: ``null`` keeps a row with the message in a bad frame's place,
    ``skip`` leaves it out, ``fail`` stops the job. A decoder that raises ends
    its container there. Errors of opening or reading a file always fail the
    task, so that Spark tries it again: a passing fault never shortens a video. Frames are yielded in small batches, so a task never
    holds a whole decoded video.

    With ``open_in_task`` the content column is not read: the task opens the
    path and the decoder gets the open file, so a video may be larger than the
    2 GB of a row and need not fit in memory.
    """
    if on_error not in ("skip", "null", "fail"):
        raise ValueError(f"on_error must be skip, null or fail, not {on_error!r}")
    schema = T.StructType([
        T.StructField(key, T.StringType()), T.StructField("frame_seq", T.LongType()),
        T.StructField("data", T.BinaryType()), T.StructField("error", T.StringType()),
    ])

    def frames_of(name: str, payload: bytes | None) -> Iterator[tuple]:
        number, source = -1, payload
        try:
            if open_in_task:
                source = open_path(name)
            for number, frame in enumerate(decoder(source)):
                if frame is not None:
                    yield name, number, frame, None
                elif on_error == "fail":
                    raise ValueError(f"{name}: frame {number} did not convert")
                elif on_error == "null":
                    yield name, number, None, "frame did not convert"
        except Exception as problem:
            if on_error == "fail" or isinstance(problem, OSError):
                raise
            if on_error == "null":
                yield name, number + 1, None, str(problem)
        finally:
            if open_in_task and source is not None:
                source.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.binary(), pa.string()]
        names = [key, "frame_seq", "data", "error"]

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, type=t) for column, t in zip(zip(*rows), types)], names=names
            )

        for incoming in batches:
            for index, name in enumerate(incoming.column(0).to_pylist()):
                payload = None if open_in_task else incoming.column(1)[index].as_py()
                held: list[tuple] = []
                for row in frames_of(name, payload):
                    held.append(row)
                    if len(held) == batch:
                        yield pack(held)
                        held = []
                if held:
                    yield pack(held)

    columns = [key] if open_in_task else [key, content]
    return containers.select(*columns).mapInArrow(run, schema)


def video_decoder(width: int = FRAME_WIDTH, height: int = FRAME_HEIGHT) -> Decoder:
    """Decoder for mp4 and other encoded video; needs the optional PyAV package."""
    try:
        import av  # noqa: F401
    except ImportError as missing:
        raise RuntimeError("decoding encoded video needs the PyAV package (import av) on all executors") from missing

    def decode(payload: bytes | BinaryIO) -> Iterator[bytes]:
        import av

        with av.open(io.BytesIO(payload) if isinstance(payload, bytes) else payload) as container:
            for frame in container.decode(video=0):
                yield frame.to_ndarray(width=width, height=height, format="bgr24").tobytes()

    return decode


def envelope(frames: DataFrame, shape: FrameShape = FrameShape(), start: Column | None = None,
             rate: float = 1.0, video: str = "path", keep: tuple[str, ...] = ()) -> DataFrame:
    """Frame rows with video, sequence, time, geometry and payload size, and the columns ``keep``."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") if start is None else start
    micros = F.unix_micros(start.cast("timestamp")) + (F.col("frame_seq") * (1_000_000 / rate)).cast("long")
    return frames.select(
        F.col(video).alias("video"), "frame_seq",
        F.timestamp_micros(micros).cast("timestamp_ntz").alias("ts"),
        F.lit(shape.width).alias("width"), F.lit(shape.height).alias("height"),
        F.lit(shape.channels).alias("channels"), "data", F.octet_length("data").alias("size_bytes"), *keep,
    )


def drop_empty(frames: DataFrame) -> DataFrame:
    return frames.filter(F.octet_length("data") > 0)


def resample_constant(frames: DataFrame, source_rate: float, rate: float) -> DataFrame:
    """First frame per output tick of a constant-rate video; row-wise, no shuffle."""
    tick = F.floor(F.col("frame_seq") * (rate / source_rate))
    before = F.floor((F.col("frame_seq") - 1) * (rate / source_rate))
    return frames.filter((F.col("frame_seq") == 0) | (tick != before))


def resample(frames: DataFrame, rate: float, video: str = "video", ts: str = "ts", seq: str = "frame_seq") -> DataFrame:
    """First frame per video and tick of ``1/rate`` seconds, for any frame times.

    Only the sequence numbers are grouped; the payload meets them in a
    semi-join instead of travelling through the grouping. For a constant rate
    ``resample_constant`` needs no join at all.
    """
    tick = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) * (rate / 1_000_000))
    kept = frames.groupBy(video, tick.alias("_tick")).agg(F.min(seq).alias(seq))
    return keep_listed(frames, kept, [video, seq])


def resize_frames(frames: DataFrame, shape: FrameShape = FrameShape(), height: int = THUMB_HEIGHT,
                  width: int = THUMB_WIDTH, gray: bool = False) -> DataFrame:
    """Replace ``data`` by the resized frame and add ``error``."""
    convert = gray_frame if gray else resize_frame
    return frames.withColumn("_r", convert(F.col("data"), shape, height, width)).withColumns(
        {"data": F.col("_r.data"), "error": F.col("_r.error")}
    ).drop("_r")


def with_features(df: DataFrame, data: str = "data", out: str = "features") -> DataFrame:
    """Feature vector of a resized frame; the same function trains and scores."""
    return df.withColumn(out, array_to_vector(signed_values(F.col(data))))


class FrameTransformer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: gray (or color) thumbnail of a raw frame; null on a bad frame."""

    sourceHeight = Param(Params._dummy(), "sourceHeight", "rows of the input frame", TypeConverters.toInt)
    sourceWidth = Param(Params._dummy(), "sourceWidth", "columns of the input frame", TypeConverters.toInt)
    height = Param(Params._dummy(), "height", "rows of the output frame", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "columns of the output frame", TypeConverters.toInt)
    gray = Param(Params._dummy(), "gray", "convert to gray first", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol="data", outputCol="processed_image", sourceHeight=FRAME_HEIGHT,
                 sourceWidth=FRAME_WIDTH, height=THUMB_HEIGHT, width=THUMB_WIDTH, gray=True):
        super().__init__()
        self._setDefault(inputCol="data", outputCol="processed_image", sourceHeight=FRAME_HEIGHT,
                         sourceWidth=FRAME_WIDTH, height=THUMB_HEIGHT, width=THUMB_WIDTH, gray=True)
        self._set(**self._input_kwargs)

    def setInputCol(self, value: str) -> FrameTransformer:
        return self._set(inputCol=value)

    def setOutputCol(self, value: str) -> FrameTransformer:
        return self._set(outputCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        shape = FrameShape(get(self.sourceHeight), get(self.sourceWidth), FRAME_CHANNELS)
        convert = gray_frame if get(self.gray) else resize_frame
        made = convert(F.col(self.getInputCol()), shape, get(self.height), get(self.width))
        return dataset.withColumn(self.getOutputCol(), made["data"])

    def transformSchema(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(self.getOutputCol(), T.BinaryType(), True)])
