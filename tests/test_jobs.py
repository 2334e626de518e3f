"""The command line jobs that need no broker or database, and the topic jobs on file streams."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reelmetry.__main__ import run
from reelmetry.plans import ingest, training
from reelmetry.operators.frames import with_features
from reelmetry.plans.inference import score_frames
from reelmetry.schemas import METRICS, FrameShape, IngestConfig
from reelmetry.sources import kafka
from reelmetry.streaming import jobs as J

SHAPE = FrameShape(256, 256, 3)


@pytest.fixture
def data(tmp_path):
    rng = np.random.default_rng(0)
    for producer in ("kafka", "zio"):
        (tmp_path / "data" / producer).mkdir(parents=True)
        for metric in METRICS:
            lines = [f"10:{i // 60:02d}:{i % 60:02d},{v:.3f}" for i, v in enumerate(rng.gamma(2, 20, 80))]
            (tmp_path / "data" / producer / f"{metric}.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "data")


def test_report_and_analyze(spark, data, tmp_path):
    run(spark, ["report", "--data", data, "--out", str(tmp_path / "report")])
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert sum(x.startswith("Table X - ") for x in lines) == 4 and sum(x.startswith("zio ") for x in lines) == 4
    run(spark, ["analyze", "--data", data, "--out", str(tmp_path / "tables")])
    assert spark.read.parquet(str(tmp_path / "tables" / "decomposition")).count() == 160
    assert spark.read.parquet(str(tmp_path / "tables" / "bottlenecks")).count() == 2


def test_image_list(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x.jpg 1\n")
    (tmp_path / "b.txt").write_text("y.jpg 2\n")
    run(spark, ["image-list", "--images", "/img", "--out", str(tmp_path / "l"), str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    assert spark.read.option("header", True).csv(str(tmp_path / "l")).count() == 2


def test_unknown_job(spark):
    with pytest.raises(SystemExit):
        run(spark, ["dance"])


def test_topic_jobs_need_the_connector(spark, tmp_path):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        run(spark, ["resize", "--servers", "broker:9092", "--checkpoint", str(tmp_path / "c")])


@pytest.fixture
def frames(tmp_path):
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (3, 256, 256, 3), dtype=np.uint8)
    (tmp_path / "videos").mkdir()
    (tmp_path / "videos" / "video_07.mp4").write_bytes(pixels.tobytes())
    return str(tmp_path / "videos"), pixels


def test_ingest_to_resize(spark, frames, tmp_path):
    folder, pixels = frames
    config = IngestConfig(folder, frame_rate=2)
    J.drain_to_table(kafka.as_messages(ingest.video_frames(spark, config), extra=("ts",)), str(tmp_path / "topic"), str(tmp_path / "c1"))
    sent = spark.read.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(sent.schema).parquet(str(tmp_path / "topic"))
    J.drain_to_table(ingest.resized_messages(stream), str(tmp_path / "small"), str(tmp_path / "c2"))
    got = {bytes(r.key).decode().rsplit("/", 2)[1:][0] + "/" + bytes(r.key).decode().rsplit("/", 1)[1]: bytes(r.value)
           for r in spark.read.parquet(str(tmp_path / "small")).collect()}
    wide = pixels.astype(int)
    means = (wide[:, 1::4, 1::4] + wide[:, 1::4, 2::4] + wide[:, 2::4, 1::4] + wide[:, 2::4, 2::4] + 2) >> 2
    assert got == {f"video_07.mp4/{i}": means[i].astype(np.uint8).tobytes() for i in range(3)}


def test_consumer_totals(spark):
    rows = [(datetime(2025, 1, 1, 0, 0, s), bytearray(n)) for s, n in ((1, 10), (5, 30))] + [(datetime(2025, 1, 1), None)]
    df = spark.createDataFrame(rows, "timestamp timestamp, value binary")
    row = ingest.consumer_totals(df, F.lit("2025-01-01 00:00:07").cast("timestamp")).first()
    assert (row.messages_consumed_total, row.message_consumption_errors_total, row.bytes_total) == (3, 1, 40)
    assert row.consumer_lag_seconds == 2.0 and row.job == "kafka-service"


def test_scoring_a_stream_equals_batch(spark, tmp_path):
    shape = FrameShape(8, 8, 3)
    rng = np.random.default_rng(7)
    rows = [(i, bytearray(rng.integers(0, 256, shape.nbytes, dtype=np.uint8).tobytes()), float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "i int, data binary, indexedLabel double")
    df.write.parquet(str(tmp_path / "in"))
    model = training.candidates(depths=(2,))[2].pipeline.fit(
        with_features(J.resize_stream(df, shape).filter("error is null")))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    J.drain_to_table(score_frames(stream, model, shape).select("i", "prediction"), str(tmp_path / "out"), str(tmp_path / "c"))
    key = lambda r: (r.i, r.prediction)
    assert sorted(map(key, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(
        map(key, score_frames(df, model, shape).collect()))
