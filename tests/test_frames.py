"""Splitting, decoding, rates, envelope and the pipeline stage."""

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from reelmetry.operators import frames as FR
from reelmetry.schemas import FRAME_SCHEMA, FrameShape, IngestConfig
from reelmetry.sources import files as SF

SHAPE = FrameShape(4, 4, 3)


@pytest.fixture(scope="module")
def videos(tmp_path_factory):
    """Raw containers of 5, 0 and 3 whole frames; the last has 7 bytes more."""
    folder = tmp_path_factory.mktemp("videos")
    rng = np.random.default_rng(1)
    payloads = {}
    for number, (frames, rest) in enumerate([(5, 0), (0, 0), (3, 7)], start=1):
        name = f"video_{number:02d}.mp4"
        payloads[name] = rng.integers(0, 256, frames * SHAPE.nbytes + rest, dtype=np.uint8).tobytes()
        (folder / name).write_bytes(payloads[name])
    (folder / "video_1.mp4").write_bytes(b"x")
    (folder / "video_001.mp4").write_bytes(b"x")
    (folder / "notes.txt").write_text("x")
    return folder, payloads


def expected_frames(payloads):
    return {
        (name, i): body[i * SHAPE.nbytes: (i + 1) * SHAPE.nbytes]
        for name, body in payloads.items() for i in range(len(body) // SHAPE.nbytes)
    }


def as_dict(df):
    return {(r.path.rsplit("/", 1)[-1], r.frame_seq): bytes(r.data) for r in df.collect()}


def test_discovery(spark, videos):
    listed = SF.list_videos(spark, str(videos[0])).collect()
    assert [r.name for r in listed] == ["video_01.mp4", "video_03.mp4"]  # video_02 is empty
    assert SF.read_binary(spark, str(videos[0])).count() == 4


def test_listing_does_not_read_content(spark, videos):
    plan = SF.list_videos(spark, str(videos[0]))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_split_raw(spark, videos):
    folder, payloads = videos
    containers = SF.read_videos(spark, str(folder), tasks=3)
    assert as_dict(FR.split_raw(containers, SHAPE)) == expected_frames(payloads)
    left = FR.split_leftovers(containers, SHAPE).collect()
    assert [(r.path.rsplit("/", 1)[-1], r.leftover_bytes) for r in left] == [("video_03.mp4", 7)]


def test_raw_file_slices_of_odd_paths(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    (folder / "video 1.mp4").write_bytes(bytes(range(96)))
    got = SF.raw_file_frames(spark, str(tmp_path) + "/*", SHAPE, "*.mp4")
    assert sorted((r.frame_seq, bytes(r.data)) for r in got.collect()) == [(0, bytes(range(48))), (1, bytes(range(48, 96)))]


@pytest.mark.parametrize("per_slice", [1, 2, 100])
def test_raw_file_slices(spark, videos, per_slice):
    folder, payloads = videos
    got = SF.raw_file_frames(spark, str(folder), SHAPE, SF.VIDEO_GLOB, per_slice)
    assert as_dict(got) == expected_frames(payloads)


@pytest.fixture
def broken_decoder():
    def decode(payload):
        yield payload[:48]
        yield None
        yield payload[:48]
        if len(payload) % 48:
            raise ValueError("bad tail")

    return decode


@pytest.mark.parametrize("on_error", ["skip", "null"])
def test_decode_errors_do_not_stop_the_job(spark, videos, broken_decoder, on_error):
    containers = SF.read_videos(spark, str(videos[0])).filter("length > 0")
    got = FR.decode_frames(containers, broken_decoder, on_error=on_error, batch=2).collect()
    seen = {n: sorted((r.frame_seq, r.error) for r in got if r.path.endswith(n)) for n in ("01.mp4", "03.mp4")}
    if on_error == "skip":
        assert seen == {"01.mp4": [(0, None), (2, None)], "03.mp4": [(0, None), (2, None)]}
    else:
        assert [r.error for r in got if r.data is None].count("frame did not convert") == 2
        assert (3, "bad tail") in seen["03.mp4"] and len(seen["01.mp4"]) == 3


def test_decoding_opened_files(spark, videos):
    folder, payloads = videos

    def read_frames(source):
        while len(frame := source.read(48)) == 48:
            yield frame

    containers = SF.read_videos(spark, str(folder))
    got = FR.decode_frames(containers, read_frames, open_in_task=True, batch=2)
    assert as_dict(got) == expected_frames(payloads)
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()
    gone = containers.select(F.concat("path", F.lit(".gone")).alias("path"))
    with pytest.raises(PythonException, match="gone"):
        FR.decode_frames(gone, read_frames, open_in_task=True).collect()


def test_read_errors_fail_the_task(spark, videos):
    def torn(payload):
        yield payload[:48]
        raise OSError("disk went away")

    for on_error in ("null", "skip"):
        with pytest.raises(PythonException, match="disk went away"):
            FR.decode_frames(SF.read_videos(spark, str(videos[0])), torn, on_error=on_error).collect()


def test_decode_can_fail(spark, videos, broken_decoder):
    with pytest.raises(PythonException, match="did not convert"):
        FR.decode_frames(SF.read_videos(spark, str(videos[0])), broken_decoder, on_error="fail").collect()
    with pytest.raises(ValueError):
        FR.decode_frames(SF.read_videos(spark, str(videos[0])), broken_decoder, on_error="ignore")


def test_video_decoder_says_what_is_missing():
    try:
        import av  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError, match="PyAV"):
            FR.video_decoder()


def test_envelope(spark, videos):
    frames = FR.split_raw(SF.read_videos(spark, str(videos[0])), SHAPE)
    start = F.lit("2025-04-29 10:00:00").cast("timestamp")
    out = FR.envelope(frames, SHAPE, start, rate=2.0)
    assert [f.name for f in out.drop("size_bytes").schema] == [f.name for f in FRAME_SCHEMA]
    assert [f.dataType for f in out.drop("size_bytes").schema] == [f.dataType for f in FRAME_SCHEMA]
    row = out.filter(F.col("video").endswith("01.mp4") & (F.col("frame_seq") == 3)).first()
    assert str(row.ts) == "2025-04-29 10:00:01.500000" and row.size_bytes == 48 and row.channels == 3


@pytest.mark.parametrize("source,rate", [(5.0, 2.0), (30.0, 1.0), (3.0, 3.0), (2.0, 5.0)])
def test_both_resamplers_agree_on_constant_rates(spark, source, rate):
    frames = spark.range(200).select(
        F.lit("v").alias("video"), F.col("id").alias("frame_seq"),
        F.timestamp_micros((F.col("id") * 1_000_000 / source).cast("long") + 1).alias("ts"),
    )
    constant = sorted(r.frame_seq for r in FR.resample_constant(frames, source, rate).collect())
    general = sorted(r.frame_seq for r in FR.resample(frames, rate).collect())
    slots = {}
    for i in range(200):
        slots.setdefault(int(i * rate / source + 1e-9), i)
    assert constant == general == sorted(slots.values())


def test_drop_empty(spark):
    df = spark.createDataFrame([(1, bytearray(b"")), (2, bytearray(b"x")), (3, None)], "i int, data binary")
    assert [r.i for r in FR.drop_empty(df).collect()] == [2]


def test_transformer_in_a_saved_pipeline(spark, tmp_path):
    rng = np.random.default_rng(4)
    frames = rng.integers(0, 256, (6, 8, 8, 3), dtype=np.uint8)
    rows = [(i, bytearray(f.tobytes())) for i, f in enumerate(frames)] + [(9, bytearray(b"short")), (10, None)]
    df = spark.createDataFrame(rows, "i int, data binary")
    stage = FR.FrameTransformer(sourceHeight=8, sourceWidth=8, height=2, width=2).setOutputCol("small")
    Pipeline(stages=[stage]).fit(df).write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    got = {r.i: r.small for r in loaded.transform(df).collect()}
    weights = np.array([3735, 19235, 9798])
    for i, f in enumerate(frames):
        gray = ((f.astype(int) * weights).sum(axis=2) + 16384) >> 15
        expected = (gray[1::4, 1::4] + gray[1::4, 2::4] + gray[2::4, 1::4] + gray[2::4, 2::4] + 2) >> 2
        assert list(got[i]) == expected.ravel().tolist()
    assert got[9] is None and got[10] is None
    schema = stage.transformSchema(df.schema)
    assert schema["small"].dataType.typeName() == "binary" and len(schema) == 3
    assert stage.transform(df).schema == schema


def test_config_checks():
    assert IngestConfig("hdfs://x/videos").frame.nbytes == 196_608
    for bad in ({"video_path": ""}, {"video_path": "p", "frame_rate": 0}, {"video_path": "p", "video_format": ""}):
        with pytest.raises(ValueError):
            IngestConfig(**bad)
    with pytest.raises(ValueError):
        FrameShape(0, 1, 1)
