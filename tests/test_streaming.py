"""Streams: parity with batch, resume after a failure, isolation, dedup."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from reelmetry.operators import counters as C
from reelmetry.operators.frames import resize_frames, split_raw
from reelmetry.schemas import FrameShape
from reelmetry.sources import files as SF
from reelmetry.sources import kafka as KF
from reelmetry.streaming import jobs as J

SHAPE = FrameShape(8, 8, 3)


@pytest.fixture
def videos(tmp_path):
    folder = tmp_path / "videos"
    folder.mkdir()
    rng = np.random.default_rng(1)

    def add(number, frames, rest=0):
        body = rng.integers(0, 256, frames * SHAPE.nbytes + rest, dtype=np.uint8).tobytes()
        (folder / f"video_{number:02d}.mp4").write_bytes(body)

    add(1, 5)
    add(2, 3, 10)
    return folder, add


def rows_of(df):
    return sorted((r.path, r.frame_seq, bytes(r.data)) for r in df.select("path", "frame_seq", "data").collect())


def test_videos_to_thumbnails_and_resume(spark, videos, tmp_path):
    folder, add = videos
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        frames = J.unfold_videos(SF.stream_videos(spark, str(folder)), SHAPE, tasks=2)
        J.drain_to_table(J.resize_stream(frames, SHAPE, 2, 2), out, checkpoint)

    def batch():
        return resize_frames(split_raw(SF.read_videos(spark, str(folder)), SHAPE), SHAPE, 2, 2)

    run()
    assert rows_of(spark.read.parquet(out)) == rows_of(batch()) and spark.read.parquet(out).count() == 8
    run()  # nothing new
    assert spark.read.parquet(out).count() == 8
    add(3, 4)
    run()
    assert rows_of(spark.read.parquet(out)) == rows_of(batch()) and spark.read.parquet(out).count() == 12


def test_restart_resumes_without_loss_or_copies(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(4):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    failures = {"left": 2}

    def flaky(batch, batch_id):
        J.write_batch_once(batch, batch_id, out)
        if batch_id == 1 and failures["left"]:
            failures["left"] -= 1
            raise RuntimeError("lost after writing")

    def start():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        return J.writer(stream, str(tmp_path / "cp"), once=True).foreachBatch(flaky).start()

    pauses = []
    assert J.run_with_restarts(start, delay_seconds=10, sleep=pauses.append) == 2
    assert pauses == [10, 10]
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))


def test_restarts_are_bounded(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))

    def broken(batch, batch_id):
        raise RuntimeError("always")

    def start():
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        return J.writer(stream, str(tmp_path / "cp"), once=True).foreachBatch(broken).start()

    pauses = []
    with pytest.raises(StreamingQueryException):
        J.run_with_restarts(start, sleep=pauses.append)
    assert len(pauses) == 3


def test_bad_records_are_kept_apart(spark, tmp_path):
    rows = [(i, bytearray(SHAPE.nbytes if i % 4 else 5)) for i in range(20)]
    spark.createDataFrame(rows, "i int, data binary").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("i int, data binary").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    J.writer(J.resize_stream(stream, SHAPE, 2, 2), str(tmp_path / "cp"), once=True).foreachBatch(
        J.split_errors(out)).start().awaitTermination()
    got = J.read_split(spark, out)
    assert sorted(r.i for r in got.filter("failed").collect()) == [0, 4, 8, 12, 16]
    assert got.filter("not failed and error is null and data is not null").count() == 15


def events(spark, path, rows):
    start = datetime(2025, 1, 1)
    data = [(j, start + timedelta(seconds=s), v) for j, s, v in rows]
    spark.createDataFrame(data, "job string, ts timestamp, value double").coalesce(1).write.mode("append").parquet(path)


def test_scrape_stream_closes_windows_by_watermark(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", 0.5, 1.0), ("a", 1.5, 2.0), ("b", 3.0, 7.0), ("a", 9.0, 3.0)]
    events(spark, source, rows)
    schema = spark.read.parquet(source).schema

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        J.drain_to_table(J.scrape_stream(stream, "ts", "value", "1 second", labels=["job"]), str(tmp_path / "out"), str(tmp_path / "cp"))
        return {(r.job, r.ts.second, r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert run() == {("a", 2, 2.0), ("b", 4, 7.0)}  # the last window is still open
    events(spark, source, [("a", 30.0, 0.0)])
    assert run() == {("a", 2, 2.0), ("b", 4, 7.0), ("a", 10, 3.0)}
    batch = C.scrape(spark.read.schema(schema).parquet(source), "ts", "value", "2 seconds", ["job"])
    assert {(r.job, r.ts.second, r.value) for r in batch.collect()} - {("a", 32, 0.0)} == run()


def test_counters_on_a_stream_equal_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    rng = np.random.default_rng(2)
    for _ in range(3):
        events(spark, source, [(str(rng.integers(3)), float(s), float(v)) for s, v in zip(rng.uniform(0, 50, 40), rng.uniform(0, 2, 40))])
    table = spark.read.parquet(source)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)

    def measure(df):
        return C.histogram(df, "value", [0.5, 1.0], ["job"])

    J.writer(measure(stream), str(tmp_path / "cp"), mode="complete", once=True).foreachBatch(
        J.replace_table(str(tmp_path / "out"))).start().awaitTermination()
    key = lambda r: (r.job, r.le, r.bucket, r["count"], round(r["sum"], 9))
    assert sorted(map(key, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(key, measure(table).collect()))


def test_repeated_messages_are_dropped(spark, tmp_path):
    frames = spark.createDataFrame(
        [("v/1", i, datetime(2025, 1, 1) + timedelta(seconds=i), bytearray([i])) for i in range(5)],
        "video string, frame_seq long, timestamp timestamp, data binary")
    sent = KF.as_messages(frames, extra=("timestamp",))
    for _ in range(2):
        sent.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    J.drain_to_table(KF.drop_repeated(KF.from_messages(stream)), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r.video, r.frame_seq, bytes(r.data)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("v/1", i, bytes([i])) for i in range(5)]


def test_unkeyed_messages(spark):
    df = spark.createDataFrame([("v", 1, bytearray(b"x"))], "video string, frame_seq long, data binary")
    row = KF.as_messages(df, keyed=False).first()
    assert row.key is None and bytes(row.value) == b"x"
    back = KF.from_messages(KF.as_messages(df, keyed=False).withColumn("timestamp", F.current_timestamp())).first()
    assert back.video is None and back.frame_seq is None


def test_kafka_options():
    options = KF.source_options("k1:9092,k2:9095", per_trigger=KF.RECORDS_PER_POLL, min_partitions=8, group_prefix="g", tuned_fetch=True)
    assert options["subscribe"] == "video-stream" and options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "50" and options["minPartitions"] == "8"
    assert options["kafka.fetch.min.bytes"] == "100000" and options["groupIdPrefix"] == "g"
    sink = KF.sink_options("k1:9092", KF.PROCESSED_TOPIC)
    assert sink["kafka.linger.ms"] == "100" and sink["kafka.acks"] == "all" and sink["topic"] == "processed-data"
    assert KF.sink_options("k", "t", wait_for_all=False, batching=False) == {"kafka.bootstrap.servers": "k", "topic": "t"}
    for bad in (lambda: KF.source_options(""), lambda: KF.sink_options("k", ""), lambda: KF.source_options("k", starting="now")):
        with pytest.raises(ValueError):
            bad()


def test_merged_streams(spark, tmp_path):
    for name, n in (("a", 3), ("b", 4)):
        spark.range(n).write.parquet(str(tmp_path / name))
    streams = [spark.readStream.schema("id long").parquet(str(tmp_path / n)).withColumn("producer", F.lit(n)) for n in "ab"]
    J.drain_to_table(J.merge_streams(*streams), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("producer").count().count() == 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7
