"""Streams that end, error tables and counts of jobs, running totals: replays, quiet times, empty inputs."""

import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmetry.operators import counters as C
from reelmetry.operators.frames import split_raw, split_raw_outcomes
from reelmetry.plans import inference, ingest, training
from reelmetry.operators.frames import with_features
from reelmetry.schemas import FrameShape, IngestConfig
from reelmetry.sources import files as SF
from reelmetry.streaming import jobs as J
from reelmetry.streaming.copies import first_copies
from reelmetry.streaming import outcomes as OC
from reelmetry.streaming import ticks as TK
from reelmetry.streaming import totals as TT

START = datetime(2025, 1, 1)
LABELS = ["application", "instance", "job"]


# Ticks ---------------------------------------------------------------

def samples(rows):
    return [(a, f"{a}:1", a, START + timedelta(seconds=s), v) for a, s, v in rows]


SCHEMA = "application string, instance string, job string, timestamp timestamp, seconds double"
#: Files in the order they arrive; the second brings a row that is late but within the delay, quiet times and nulls.
FILES = [
    [("a", 0.5, 1.0), ("a", 1.5, 2.0), ("a", 9.1, 3.0), ("b", 3.0, 7.0)],
    [("a", 8.9, 2.5), ("a", 21.0, 4.0), ("a", 21.5, 5.0), ("a", 22.0, None), ("b", 20.0, 8.0), ("b", 20.0, 9.0)],
    [("b", 33.9, 6.0), ("c", 40.0, 1.5)],
]


def expected_ticks(width, fill):
    last = {}
    for a, s, v in sorted((r for f in FILES for r in f if r[2] is not None), key=lambda r: (r[1], r[2])):
        last[a, int(s // width + 1) * width] = v
    end = max(t for _, t in last)
    out = []
    for a in {a for a, _ in last}:
        value = None
        for tick in range(min(t for b, t in last if b == a), end + 1, width):
            if (a, tick) in last or fill:
                value = last.get((a, tick), value)
                out.append((a, START + timedelta(seconds=tick), value))
    return sorted(out)


@pytest.mark.parametrize("fill", [True, False])
def test_every_tick_to_the_end(spark, tmp_path, fill):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate(FILES):
        spark.createDataFrame(samples(rows), SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)

    def scraped(s):
        s = s if fill else s.where("seconds IS NOT NULL OR application IS NULL")
        return (TK.scrape_ticks if fill else J.scrape_stream)(s, "timestamp", "seconds", "15 seconds", 2 if fill else "2 seconds")

    with TK.rocks_db(spark):
        TK.drain_to_end(stream, "timestamp", scraped, out, str(tmp_path / "c"), 2, 15)
    got = sorted((r.application, r.ts.replace(tzinfo=None), r.value) for r in spark.read.parquet(out).collect())
    wanted = expected_ticks(2, fill)
    assert [(a, t.strftime("%H:%M:%S"), v) for a, t, v in got] == [(a, t.strftime("%H:%M:%S"), v) for a, t, v in wanted]


def test_an_empty_input_has_no_ticks(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    before = spark.conf.get(TK.STATE_STORE, None)
    with TK.rocks_db(spark):
        TK.drain_to_end(stream, "timestamp", lambda s: TK.scrape_ticks(s, "timestamp", "seconds", "0 seconds"), out, str(tmp_path / "c"), 2)
    assert spark.read.schema("application string, value double").parquet(out).count() == 0
    assert spark.conf.get(TK.STATE_STORE, None) == before


# Outcomes ------------------------------------------------------------

def frames_of(spark, rows):
    return spark.createDataFrame(rows, "key int, value binary, error string")


ROWS = [(1, bytearray(b"a"), None), (2, None, "bad"), (3, bytearray(b"c"), None)]


def test_a_replayed_batch_replaces_its_outcomes(spark, tmp_path):
    path, sent = str(tmp_path / "t"), []
    failing = {"left": 1}

    def send(good):
        keys = sorted(r.key for r in good.collect())
        if failing["left"]:
            failing["left"] -= 1
            raise RuntimeError("broker gone")
        sent.append(keys)

    write = OC.keep_outcomes(path, send)
    with pytest.raises(RuntimeError):
        write(frames_of(spark, ROWS), 0)
    assert OC.read_counts(spark, path).count() == 0  # the batch isn't done
    write(frames_of(spark, ROWS), 0)
    write(frames_of(spark, ROWS), 0)
    write(frames_of(spark, [(4, None, "worse")]), 1)
    write(frames_of(spark, []), 2)
    assert sent == [[1, 3], [1, 3]]
    assert sorted(r.key for r in OC.read_rows(spark, path).collect()) == [1, 3]
    assert sorted((r.key, r.error) for r in OC.read_rows(spark, path, failed=True).collect()) == [(2, "bad"), (4, "worse")]
    assert sorted((r.batch_id, r.rows, r.failures) for r in OC.read_counts(spark, path).collect()) == [(0, 3, 1), (1, 1, 1), (2, 0, 0)]


def test_sent_outcomes_note_failures_only(spark, tmp_path):
    spark = spark.newSession()  # as in a stream, whose batches have a session of their own
    path, sent = str(tmp_path / "t"), []
    write = OC.send_outcomes(path, lambda good: sent.append(sorted(r.key for r in good.collect())), ("key",))
    write(frames_of(spark, [ROWS[0]]), 0)
    assert OC.read_errors(spark, path).count() == 0 and not os.path.exists(f"{path}/errors")
    write(frames_of(spark, ROWS), 1)
    write(frames_of(spark, ROWS), 1)
    assert sent == [[1], [1, 3], [1, 3]]
    assert [tuple(r) for r in OC.read_errors(spark, path).select("key", "error").collect()] == [(2, "bad")]
    assert sorted((r.batch_id, r.rows, r.failures) for r in OC.read_counts(spark, path).collect()) == [(0, 1, 0), (1, 3, 1)]


def test_partial_and_empty_containers_are_rows(spark):
    shape = FrameShape(2, 2, 1)
    rows = [("a", bytearray(b"12345678")), ("b", bytearray(b"123456")), ("c", bytearray()), ("d", None), ("e", bytearray(b"12"))]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = sorted((r.path, r.frame_seq, bytes(r.data) if r.data else None, r.error) for r in split_raw_outcomes(df, shape).collect())
    assert got == [
        ("a", 0, b"1234", None), ("a", 1, b"5678", None), ("b", 0, b"1234", None), ("b", 1, None, "partial frame of 2 bytes"),
        ("c", 0, None, "empty container"), ("d", 0, None, "empty container"), ("e", 0, None, "partial frame of 2 bytes"),
    ]
    whole = sorted((r.path, r.frame_seq, bytes(r.data)) for r in split_raw(df, shape).collect())
    assert [g[:3] for g in got if g[3] is None] == whole


def test_ingest_job_counts_and_lists_bad_frames(spark, tmp_path):
    shape = FrameShape(4, 4, 3)
    folder, sent = tmp_path / "videos", str(tmp_path / "sent")
    folder.mkdir()
    (folder / "video_01.mp4").write_bytes(bytes(range(48)) * 3 + b"rest")
    (folder / "video_02.mp4").write_bytes(bytes(48))

    def decoder(source):
        payload = source.read()
        yield from (payload[i : i + 48] if len(payload[i : i + 48]) == 48 else None for i in range(0, len(payload), 48))

    for name, own in (("raw", None), ("decoded", decoder)):
        table = str(tmp_path / name)
        config = IngestConfig(str(folder), "none:1", frame=shape)
        query = ingest.ingest(spark, config, str(tmp_path / f"{name}.c"), table, own, send=lambda m, name=name: m.write.mode("append").parquet(f"{sent}-{name}"))
        query.processAllAvailable()
        query.stop()
        assert OC.read_counts(spark, table).agg(F.sum("rows"), F.sum("failures")).first() == (5, 1)
        errors = OC.read_errors(spark, table).collect()
        assert [(r.video.rsplit("/", 1)[1], r.frame_seq) for r in errors] == [("video_01.mp4", 3)]
        assert errors[0].error == ("partial frame of 4 bytes" if own is None else "frame did not convert")
        assert spark.read.parquet(f"{sent}-{name}").count() == 4


def test_scores_of_bad_frames_are_messages(spark, tmp_path):
    shape = FrameShape(8, 8, 3)
    rng = np.random.default_rng(7)
    rows = [(i, bytearray(rng.integers(0, 256, shape.nbytes, dtype=np.uint8).tobytes()), float(i % 2), None) for i in range(20)]
    good = spark.createDataFrame(rows, "i int, data binary, indexedLabel double, error string")
    bad = spark.createDataFrame([(99, bytearray(b"x"), 0.0, None), (98, None, 0.0, "lost"), (97, None, 0.0, None)], good.schema)
    model = training.candidates(depths=(2,))[2].pipeline.fit(with_features(J.resize_stream(good.drop("error"), shape, 2, 2)))
    got = {r.i: r for r in inference.score_outcomes(good.union(bad), model, shape, 2, 2).collect()}
    plain = {r.i: r for r in model.transform(with_features(J.resize_stream(good.drop("error"), shape, 2, 2))).collect()}
    assert all(got[i].prediction == plain[i].prediction and bytes(got[i].data) == bytes(plain[i].data) and got[i].error is None for i in range(20))
    assert all(list(got[i].features) == list(plain[i].features) for i in range(20))
    assert {i: (got[i].prediction, got[i].data, got[i].error) for i in (97, 98, 99)} == {
        97: (None, None, "missing frame"), 98: (None, None, "lost"), 99: (None, None, "frame size 1 is not 192")}


def test_frames_are_converted_once(spark):
    shape = FrameShape(8, 8, 3)
    frames = spark.createDataFrame([(1, bytearray(192))], "i int, data binary")
    fitted = training.candidates(depths=(2,))[2].pipeline.fit(
        with_features(J.resize_stream(frames, shape, 2, 2)).withColumn("indexedLabel", F.lit(0.0)))
    scored = inference.score_outcomes(frames, fitted, shape, 2, 2)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("convert(") == 1, plan


# Totals --------------------------------------------------------------

def messages(spark, rows):
    made = [("s", "s:1", "s" if i % 3 else "t", START + timedelta(seconds=i), bytearray(b"x" * i) if i % 4 else None, float(i)) for i in rows]
    return spark.createDataFrame(made, "application string, instance string, job string, timestamp timestamp, value binary, seconds double")


def summary(batch):
    return TT.consumption_summary(batch, "seconds", F.col("value").isNull(), latest=("seconds",), bounds=(2.0, 8.0, 30.0))


def totals_of(spark, path):
    return sorted(tuple(r) for r in TT.histogram_rows(TT.read_totals(spark, path), (2.0, 8.0, 30.0)).collect())


def test_totals_of_batches_are_the_totals_of_all(spark, tmp_path):
    path, one = str(tmp_path / "many"), str(tmp_path / "one")
    with pytest.raises(FileNotFoundError):
        TT.read_totals(spark, path)
    write = TT.add_to_totals(path, summary)
    for n in range(5):
        write(messages(spark, range(n * 10, n * 10 + 10)), n)
        write(messages(spark, range(n * 10, n * 10 + 10)), n)  # every batch is replayed
    write(messages(spark, []), 5)
    TT.add_to_totals(one, summary)(messages(spark, range(50)), 0)
    assert totals_of(spark, path) == totals_of(spark, one)
    assert sorted(os.listdir(path)) == ["batch_id=4", "batch_id=5"]
    newest = {r.job: r.newest.seconds for r in TT.read_totals(spark, path).collect()}
    assert newest == {"s": 49.0, "t": 48.0}


def test_histogram_of_totals_equals_the_plain_one(spark, tmp_path):
    path = str(tmp_path / "t")
    TT.add_to_totals(path, summary)(messages(spark, range(50)), 0)
    plain = C.histogram(messages(spark, range(50)), "seconds", (2.0, 8.0, 30.0))
    got = {(r[2], r[3]): (r[4], r[5], r[6]) for r in totals_of(spark, path)}
    assert got == {(r.job, r.le): (r.bucket, r["count"], r["sum"]) for r in plain.collect()}


def test_unfinished_totals_are_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    write = TT.add_to_totals(path, summary)
    write(messages(spark, range(5)), 0)
    os.makedirs(f"{path}/batch_id=1")  # a write that was cut off
    before = totals_of(spark, path)
    write(messages(spark, []), 2)
    assert totals_of(spark, path) == before


# Arriving files ------------------------------------------------------

@pytest.mark.parametrize("per_slice", [1, 3, 512])
def test_files_are_read_in_slices(spark, tmp_path, per_slice):
    shape, folder = FrameShape(2, 2, 1), tmp_path / "v"
    folder.mkdir()
    bodies = {"video_01.mp4": b"abcdefghijklmnop", "video_02.mp4": b"123456", "video_03.mp4": b"12", "video_04.mp4": bytes(range(44))}
    for name, body in bodies.items():
        (folder / name).write_bytes(body)
    (folder / "other.txt").write_bytes(b"xxxx")
    for rate, source in ((1, None), (2, 5.0)):
        config = IngestConfig(str(folder), frame=shape, frame_rate=rate, source_rate=source)
        out = str(tmp_path / f"out-{rate}")
        J.drain_to_table(ingest.video_outcomes(spark, config, tasks=3, frames_per_slice=per_slice), out, f"{out}.c")
        got = sorted((r.video.rsplit("/", 1)[1], r.frame_seq, bytes(r.data) if r.data else None, r.error) for r in spark.read.parquet(out).collect())
        wanted = []
        for name, body in bodies.items():
            for i in range(0, len(body), 4):
                n, frame = i // 4, body[i : i + 4]
                if len(frame) < 4:
                    wanted.append((name, n, None, f"partial frame of {len(frame)} bytes"))
                elif source is None or n == 0 or n * 2 // 5 != (n - 1) * 2 // 5:
                    wanted.append((name, n, frame, None))
        assert got == sorted(wanted)
    assert SF.stream_listing(spark, str(folder)).columns == ["path", "length"]


def test_more_slices_than_files_use_more_tasks(spark, tmp_path):
    (tmp_path / "video_01.mp4").write_bytes(bytes(4 * 400))
    listing = SF.read_binary(spark, str(tmp_path)).select("path", "length")
    frames = SF.slice_outcomes(SF.raw_slices(listing, FrameShape(2, 2, 1), 10), FrameShape(2, 2, 1), tasks=4)
    assert frames.select(F.spark_partition_id().alias("p")).distinct().count() == 4
    assert frames.count() == 400


# Copies --------------------------------------------------------------

def test_copies_over_batches_pass_once(spark, tmp_path, monkeypatch):
    schema = "video string, frame_seq long, data string"
    batches = [
        [("a", 0, "x"), ("a", 0, "x"), ("a", 1, "x"), ("b", 0, "x"), ("a", None, "n")],
        [("a", 1, "x"), ("a", 4095, "x"), ("a", 4096, "x"), ("a", None, "n"), ("b", 10**12, "x")],
        [("a", 0, "x"), ("a", 4096, "x"), ("b", 10**12, "x"), (None, 5, "x"), (None, 5, "x")],
        [("full", i % 4096, "x") for i in range(5000)],
        [("full", 17, "x"), ("full", 4097, "x")],
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    with TK.rocks_db(spark):
        J.drain_to_table(first_copies(stream), out, str(tmp_path / "c"))
    got = sorted(((r.video, r.frame_seq) for r in spark.read.parquet(out).collect()), key=str)
    named = {(v, n) for rows in batches for v, n, _ in rows if n is not None}
    assert got == sorted([*named, ("a", None), ("a", None)], key=str)
