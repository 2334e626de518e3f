"""Pixel kernels against plain per-pixel formulas."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelmetry.functions import pixels as P
from reelmetry.schemas import FrameShape

RNG = np.random.default_rng(8)


def bilinear(image, height, width):
    """One pixel at a time, from the rule in words."""
    h, w, c = image.shape

    def axis(i, source, target):
        centre = (i + 0.5) * source / target - 0.5
        left = int(np.floor(centre))
        share = centre - left
        if left < 0:
            left, share = 0, 0.0
        if left >= source - 1:
            left, share = source - 1, 0.0
        return left, min(left + 1, source - 1), int(np.rint(share * 2048))

    out = np.zeros((height, width, c), dtype=np.uint8)
    for y in range(height):
        t, b, wy = axis(y, h, height)
        for x in range(width):
            l, r, wx = axis(x, w, width)
            for k in range(c):
                up = int(image[t, l, k]) * (2048 - wx) + int(image[t, r, k]) * wx
                low = int(image[b, l, k]) * (2048 - wx) + int(image[b, r, k]) * wx
                value = ((((2048 - wy) * (up >> 4)) >> 16) + ((wy * (low >> 4)) >> 16) + 2) >> 2
                out[y, x, k] = min(max(value, 0), 255)
    return out


@pytest.mark.parametrize("source,target", [((8, 8), (2, 2)), ((8, 8), (3, 3)), ((7, 5), (4, 9)), ((4, 4), (8, 8)), ((1, 1), (3, 2))])
@pytest.mark.parametrize("channels", [1, 3])
def test_resize(source, target, channels):
    frames = RNG.integers(0, 256, (3, *source, channels), dtype=np.uint8)
    got = P.resize_pixels(frames, *target)
    for frame, made in zip(frames, got):
        np.testing.assert_array_equal(made, bilinear(frame, *target))


def test_shrink_by_four_is_the_mean_of_the_centre():
    frame = np.zeros((1, 4, 4, 1), dtype=np.uint8)
    frame[0, 1:3, 1:3, 0] = [[10, 11], [12, 14]]
    assert P.resize_pixels(frame, 1, 1).item() == (10 + 11 + 12 + 14 + 2) // 4
    assert P.resize_pixels(np.full((1, 256, 256, 3), 255, np.uint8), 64, 64).min() == 255


def test_gray():
    colors = np.array([[[[255, 0, 0], [0, 255, 0], [0, 0, 255], [255, 255, 255], [1, 2, 3]]]], dtype=np.uint8)
    expected = [(3735 * b + 19235 * g + 9798 * r + 16384) >> 15 for b, g, r in colors[0, 0].astype(int)]
    assert P.gray_pixels(colors)[0, 0, :, 0].tolist() == expected == [29, 150, 76, 255, 2]


def test_payload_of_sliced_arrays():
    whole = P._as_binary(pa.array([b"abc", b"", b"de", b"f"], type=pa.binary()))
    assert P._payload(whole).tobytes() == b"abcdef"
    assert P._payload(whole[1:3]).tobytes() == b"de"
    assert P._payload(whole[:0]).size == 0


def test_resize_column_with_bad_frames(spark):
    good = [RNG.integers(0, 256, (8, 8, 3), dtype=np.uint8) for _ in range(50)]
    rows = [(i, bytearray(f.tobytes())) for i, f in enumerate(good)]
    rows += [(100, None), (101, bytearray(b"")), (102, bytearray(191)), (103, bytearray(193))]
    df = spark.createDataFrame(rows, "i int, data binary").repartition(3)
    got = {r.i: r.r for r in df.select("i", P.resize_frame(F.col("data"), FrameShape(8, 8, 3), 2, 2).alias("r")).collect()}
    for i, frame in enumerate(good):
        assert bytes(got[i].data) == bilinear(frame, 2, 2).tobytes() and got[i].error is None
    assert all(got[i].data is None for i in range(100, 104))
    assert [got[i].error for i in range(100, 104)] == [
        "missing frame", "frame size 0 is not 192", "frame size 191 is not 192", "frame size 193 is not 192"]


def test_only_bad_frames(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(b"x"))], "i int, data binary").coalesce(1)
    got = df.select(P.resize_frame(F.col("data"), FrameShape(8, 8, 3), 2, 2).alias("r")).collect()
    assert [r.r.data for r in got] == [None, None]


def test_signed_values(spark):
    rows = [(0, bytearray([0, 127, 128, 255])), (1, None), (2, bytearray(b"")), (3, bytearray([1]))]
    df = spark.createDataFrame(rows, "i int, data binary").coalesce(1)
    got = {r.i: r.v for r in df.select("i", P.signed_values(F.col("data")).alias("v")).collect()}
    assert got == {0: [0.0, 127.0, -128.0, -1.0], 1: None, 2: [], 3: [1.0]}


def test_gray_needs_three_channels():
    with pytest.raises(ValueError):
        P._frames_udf(FrameShape(4, 4, 1), 1, 1, gray=True)
