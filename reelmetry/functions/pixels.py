"""Pixel kernels: numpy on whole Arrow batches of frames.

Spark partitions the frames; a kernel sees one batch of one column. Frames of
one shape are stacked and processed together without a Python loop per row.

Rules (8-bit): bilinear sampling at ``(d + 0.5) * src / dst - 0.5`` with
clamped neighbours and 11-bit integer weights; a 4:1 shrink is then the rounded
mean of the four centre pixels of each 4x4 cell. Gray is
``(3735 B + 19235 G + 9798 R + 16384) >> 15``.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmetry.schemas import THUMB_HEIGHT, THUMB_WIDTH, FrameShape

# Ship the kernels with the job, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: BGR weights in 1/32768 and bits of an interpolation weight ---
GRAY_WEIGHTS = (3735, 19235, 9798)
GRAY_BITS = 15
WEIGHT_BITS = 11

#: Most row pairs that an expression cuts out one by one; taller frames are sent whole.
MOST_PAIRS = 512


def _axis_weights(source: int, target: int):
    """Left neighbour, right neighbour and right weight for every target index."""
    centre = (np.arange(target) + 0.5) * (source / target) - 0.5
    left = np.floor(centre).astype(np.int64)
    fraction = centre - left
    fraction = np.where((left < 0) | (left >= source - 1), 0.0, fraction)
    left = np.clip(left, 0, source - 1)
    right = np.minimum(left + 1, source - 1)
    weight = np.rint(fraction * (1 << WEIGHT_BITS)).astype(np.int32)
    return left, right, weight


def resize_pixels(frames: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize of uint8 frames shaped (n, h, w, c)."""
    _, h, w, _ = frames.shape
    if (h, w) == (height, width):
        return frames
    if h == 4 * height and w == 4 * width:
        # All weights are one half: only 4 of 16 source pixels are read.
        total = frames[:, 1::4, 1::4].astype(np.uint16)
        total += frames[:, 1::4, 2::4]
        total += frames[:, 2::4, 1::4]
        total += frames[:, 2::4, 2::4]
        total += 2
        return (total >> 2).astype(np.uint8)
    top, bottom, wy = _axis_weights(h, height)
    left, right, wx = _axis_weights(w, width)
    one = 1 << WEIGHT_BITS
    wx, wy = wx[None, None, :, None], wy[None, :, None, None]

    def across(rows: np.ndarray) -> np.ndarray:
        block = frames[:, rows].astype(np.int32)
        return block[:, :, left] * (one - wx) + block[:, :, right] * wx

    upper = ((one - wy) * (across(top) >> 4)) >> 16
    lower = (wy * (across(bottom) >> 4)) >> 16
    return np.clip((upper + lower + 2) >> 2, 0, 255).astype(np.uint8)


def shrink_pairs(pairs: np.ndarray) -> np.ndarray:
    """The 4:1 shrink of frames of which only the two middle rows of every four are there, shaped (n, h / 2, w, c)."""
    total = pairs[:, 0::2, 1::4].astype(np.uint16)
    total += pairs[:, 0::2, 2::4]
    total += pairs[:, 1::2, 1::4]
    total += pairs[:, 1::2, 2::4]
    total += 2
    return (total >> 2).astype(np.uint8)


def gray_pixels(frames: np.ndarray) -> np.ndarray:
    """BGR frames (n, h, w, 3) to gray frames (n, h, w, 1)."""
    b, g, r = (frames[..., i].astype(np.int32) * GRAY_WEIGHTS[i] for i in range(3))
    return ((b + g + r + (1 << (GRAY_BITS - 1))) >> GRAY_BITS).astype(np.uint8)[..., None]


def _as_binary(array: pa.Array) -> pa.Array:
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    return array if pa.types.is_large_binary(array.type) else array.cast(pa.large_binary())


def _payload(array: pa.Array) -> np.ndarray:
    """All bytes of a binary array without nulls, back to back."""
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset: array.offset + len(array) + 1]
    if len(array) == 0 or array.buffers()[2] is None:
        return np.empty(0, dtype=np.uint8)
    return np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0]: offsets[-1]]


def _binary_array(flat: np.ndarray, size: int, present: np.ndarray) -> pa.Array:
    """Rows of ``size`` bytes where ``present``, null elsewhere."""
    lengths = np.where(present, size, 0)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    bitmap = pa.py_buffer(np.packbits(present, bitorder="little").tobytes())
    buffers = [bitmap, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(flat).reshape(-1))]
    return pa.Array.from_buffers(pa.large_binary(), len(present), buffers).cast(pa.binary())


def _in_pairs(shape: FrameShape, height: int, width: int) -> bool:
    """Whether a resize is the 4:1 shrink, which needs two rows of four."""
    return (shape.height, shape.width) == (4 * height, 4 * width) and height <= MOST_PAIRS


def _sent(data: Column, shape: FrameShape, height: int, width: int) -> Column:
    """The bytes that a kernel needs of a frame, cut out before they leave the JVM; null for a payload of a wrong size."""
    right = F.octet_length(data) == shape.nbytes
    if not _in_pairs(shape, height, width):
        return F.when(right, data)
    row = shape.width * shape.channels
    return F.when(right, F.concat(*[F.substring(data, (4 * y + 1) * row + 1, 2 * row) for y in range(height)]))


def _resized(data: pa.Array, shape: FrameShape, height: int, width: int, gray: bool) -> tuple[np.ndarray, np.ndarray]:
    """The resized frames of the payloads that are there, and which are."""
    data = _as_binary(data)
    present = np.asarray(pc.is_valid(data).to_numpy(zero_copy_only=False), dtype=bool)
    pairs = _in_pairs(shape, height, width)
    frames = _payload(data.filter(pa.array(present))).reshape(-1, 2 * height if pairs else shape.height, shape.width, shape.channels)
    frames = gray_pixels(frames) if gray else frames
    return shrink_pairs(frames) if pairs else resize_pixels(frames, height, width), present


def _frames_udf(shape: FrameShape, height: int, width: int, gray: bool):
    """Arrow function from what ``_sent`` sends of frames of one shape to resized frames; null stays null."""
    if gray and shape.channels != 3:
        raise ValueError("gray conversion needs 3 channels")

    @F.arrow_udf(T.BinaryType())
    def convert(data: pa.Array) -> pa.Array:
        out, present = _resized(data, shape, height, width, gray)
        return _binary_array(out, height * width * out.shape[-1], present)

    return convert


def size_error(data: Column, shape: FrameShape) -> Column:
    """Why a payload is no frame of this shape; null when it is one."""
    return (
        F.when(data.isNull(), F.lit("missing frame"))
        .when(F.octet_length(data) != shape.nbytes,
              F.concat(F.lit("frame size "), F.octet_length(data).cast("string"), F.lit(f" is not {shape.nbytes}")))
    )


def resize_frame(data: Column, shape: FrameShape = FrameShape(),
                 height: int = THUMB_HEIGHT, width: int = THUMB_WIDTH) -> Column:
    """Struct (data, error): the resized frame, or null and the reason."""
    out = _frames_udf(shape, height, width, gray=False)(_sent(data, shape, height, width))
    return F.struct(out.alias("data"), size_error(data, shape).alias("error"))


def gray_frame(data: Column, shape: FrameShape = FrameShape(),
               height: int = THUMB_HEIGHT, width: int = THUMB_WIDTH) -> Column:
    """Struct (data, error): gray, then resized."""
    out = _frames_udf(shape, height, width, gray=True)(_sent(data, shape, height, width))
    return F.struct(out.alias("data"), size_error(data, shape).alias("error"))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _signed_doubles(data: pa.Array) -> pa.Array:
    data = _as_binary(data)
    known = pc.fill_null(pc.is_valid(data), False)
    values = _payload(data.filter(known)).view(np.int8).astype(np.float64)
    lengths = pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    mask = pc.invert(known)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=mask)


def signed_values(data: Column) -> Column:
    """Bytes as doubles from -128 to 127, the sign a JVM byte has."""
    return _signed_doubles(data)


def frame_features(data: Column, shape: FrameShape = FrameShape(), height: int = THUMB_HEIGHT, width: int = THUMB_WIDTH) -> Column:
    """Struct (data, features): the resized frame and its signed values, from one conversion; a bad frame has null and zeros."""
    size = height * width * shape.channels

    @F.arrow_udf(T.StructType([T.StructField("data", T.BinaryType()), T.StructField("features", T.ArrayType(T.FloatType()))]))
    def convert(data: pa.Array) -> pa.Array:
        out, present = _resized(data, shape, height, width, gray=False)
        values = np.zeros((len(present), size), dtype=np.float32)
        values[present] = np.ascontiguousarray(out).reshape(-1, size).view(np.int8)
        offsets = np.arange(0, (len(present) + 1) * size, size, dtype=np.int32)
        features = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))
        return pa.StructArray.from_arrays([_binary_array(out, size, present), features], names=["data", "features"])

    return convert(_sent(data, shape, height, width))


def make_image_resizer(height: int, width: int):
    """Arrow function for images of any size and 1, 3 or 4 channels, as 3-channel BGR."""

    @F.arrow_udf(T.BinaryType())
    def convert(data: pa.Array, h: pa.Array, w: pa.Array, channels: pa.Array) -> pa.Array:
        out = []
        for raw, rows, cols, depth in zip(data, h.to_pylist(), w.to_pylist(), channels.to_pylist()):
            raw = raw.as_buffer() if raw.is_valid else None
            if raw is None or not rows or rows < 1 or raw.size != rows * cols * depth:
                out.append(None)
                continue
            image = np.frombuffer(raw, dtype=np.uint8).reshape(1, rows, cols, depth)
            image = np.repeat(image, 3, axis=3) if depth == 1 else image[..., :3]
            out.append(resize_pixels(image, height, width).tobytes())
        return pa.array(out, type=pa.binary())

    return convert


def resize_image(image: Column, height: int = THUMB_HEIGHT, width: int = THUMB_WIDTH) -> Column:
    """Resized BGR bytes of an ``image`` source struct; null when it was unreadable."""
    return make_image_resizer(height, width)(image["data"], image["height"], image["width"], image["nChannels"])
