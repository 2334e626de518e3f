"""File sources and sinks on written fixtures."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmetry.functions import text as X
from reelmetry.operators.series import mean_duplicates, wide_table
from reelmetry.plans.etl import copy_database_table, copy_table
from reelmetry.plans.producer_report import producer_stats
from reelmetry.schemas import METRICS
from reelmetry.sinks import tables as K
from reelmetry.sources import files as SF
from reelmetry.sources import tables as ST


@pytest.fixture(scope="module")
def metric_folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("data")
    clock = ["10:00:00", "10:00:02", "10:00:02", "10:00:04"]
    fine = ["10:00:00.5", "10:00:02.25", "10:00:03.123456"]
    full = ["2025-04-29 15:08:30", "2025-04-29 15:08:32"]
    for producer in ("kafka", "zio"):
        (base / producer).mkdir()
        for metric in METRICS:
            (base / producer / f"{metric}.csv").write_text("".join(f"{t},{i + 1}.5\n" for i, t in enumerate(clock)))
    (base / "kafka" / "Memory.csv").write_text("".join(f"{t},{i}\n" for i, t in enumerate(fine)))
    (base / "kafka" / "Cons_lag.csv").write_text("".join(f"{t},{i}\n" for i, t in enumerate(full)))
    (base / "zio" / "CPU.csv").unlink()
    (base / "zio" / "Memory.csv").write_text("")
    (base / "zio" / "Throughput.csv").write_text("10:00:00,4\nnonsense,6\n10:00:04,broken\n")
    (base / "empty_producer").mkdir()
    return str(base)


def test_metric_files(spark, metric_folder):
    samples = SF.read_metric_files(spark, metric_folder).cache()
    assert {r.producer for r in SF.producers(samples).collect()} == {"kafka", "zio"}
    missing = {(r.producer, r.metric) for r in SF.missing_files(samples).collect()}
    assert missing == {("zio", "CPU"), ("zio", "Memory")}

    def times(producer, metric):
        rows = samples.filter((F.col("producer") == producer) & (F.col("metric") == metric)).orderBy("seq").collect()
        return [(str(r.ts), r.value) for r in rows]

    assert times("kafka", "CPU")[:2] == [("1900-01-01 10:00:00", 1.5), ("1900-01-01 10:00:02", 2.5)]
    assert [t for t, _ in times("kafka", "Memory")] == [
        "1900-01-01 10:00:00.500000", "1900-01-01 10:00:02.250000", "1900-01-01 10:00:03.123456"]
    assert [t for t, _ in times("kafka", "Cons_lag")] == ["2025-04-29 15:08:30", "2025-04-29 15:08:32"]
    assert times("zio", "Throughput") == [("1900-01-01 10:00:00", 4.0), ("None", 6.0), ("1900-01-01 10:00:04", None)]
    means = mean_duplicates(samples).filter("producer = 'kafka' and metric = 'CPU'").orderBy("ts").collect()
    assert [r.value for r in means] == [1.5, 3.0, 4.5]


def test_report_from_files(spark, metric_folder):
    stats = producer_stats(SF.read_metric_files(spark, metric_folder)).toPandas().set_index("producer")
    assert stats.loc["kafka", "frames_produced_total"] == 4.5
    assert stats.loc["kafka", "frame_production_rate"] == 1.0
    assert stats.loc["zio", "cpu_usage"] == 0.0 and stats.loc["zio", "memory_usage"] == 0.0
    assert stats.loc["zio", "avg_throughput"] == 5.0
    assert wide_table(SF.read_metric_files(spark, metric_folder)).filter("producer = 'zio'").count() == 3


def test_file_order_survives_splits(spark, tmp_path):
    """A file read in many splits, next to others in the same tasks."""
    (tmp_path / "p").mkdir()
    sizes = {"CPU": 5000, "Memory": 700, "Disk_read": 3000}
    for name, n in sizes.items():
        (tmp_path / "p" / f"{name}.csv").write_text("".join(f"10:00:00,{i}\n" for i in range(n)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        samples = SF.read_metric_files(spark, str(tmp_path))
        assert samples.rdd.getNumPartitions() > 8
        rows = samples.orderBy("metric", "seq").select("metric", "value", "seq").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, n in sizes.items():
        mine = [r for r in rows if r.metric == name]
        assert [r.value for r in mine] == [float(i) for i in range(n)]
        assert len({r.seq for r in mine}) == n


@pytest.fixture(scope="module")
def pictures(tmp_path_factory, write_png):
    folder = tmp_path_factory.mktemp("pictures")
    rng = np.random.default_rng(6)
    arrays = {}
    for name in ("c.JPG", "a.JPG", "b.JPG"):
        arrays[name] = rng.integers(0, 256, (6, 5, 3), dtype=np.uint8)
        write_png(folder / name, arrays[name])
    (folder / "bad.JPG").write_bytes(b"no picture")
    return folder, arrays


def test_images_are_bgr_and_bad_ones_flagged(spark, pictures):
    folder, arrays = pictures
    got = {r.path.rsplit("/", 1)[-1]: r.image for r in SF.read_images(spark, str(folder)).collect()}
    assert bytes(got["a.JPG"].data) == arrays["a.JPG"].tobytes() and got["a.JPG"].nChannels == 3
    assert got["bad.JPG"].height == -1


def test_image_sequence(spark, pictures):
    rows = SF.image_sequence(spark, str(pictures[0]), rate=2.0).orderBy("frame_seq").collect()
    assert [r["name"] for r in rows] == ["a.JPG", "b.JPG", "bad.JPG", "c.JPG"]
    assert str(rows[3].ts) == "1970-01-01 00:00:01.500000"


@pytest.mark.parametrize("limit", [100, 1])
def test_image_lookup(spark, pictures, limit):
    folder, _ = pictures
    listed = spark.createDataFrame(
        [(f"{folder}/a.JPG", "x"), (f"{folder}/a.JPG", "y"), (f"{folder}/c.JPG", "x"), (f"{folder}/none.JPG", "x")],
        SF.IMAGE_LIST_SCHEMA)
    images = SF.read_images(spark, str(folder))
    got = sorted((r.image_path.rsplit("/", 1)[-1], r.label) for r in SF.lookup_images(listed, images, limit).collect())
    assert got == [("a.JPG", "x"), ("a.JPG", "y"), ("c.JPG", "x")]
    assert [r.image_path for r in SF.unmatched_images(listed, images).collect()] == [f"{folder}/none.JPG"]


def test_bare_path(spark):
    paths = ["file:///a/b", "file:/a/b", "hdfs://host:8020/a/b", "/a/b", "s3a://bucket/a/b", "a/b"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(SF.bare_path(F.col("p"))).collect()] == ["/a/b"] * 5 + ["a/b"]


def test_label_texts_to_csv(spark, tmp_path):
    parts = {"train": "img/1.jpg 3\n  img/2.jpg\t4  \n", "val": "/abs/3.jpg 5\nbroken\n", "test": "img/1.jpg 3\na b c\n"}
    for name, body in parts.items():
        (tmp_path / f"{name}.txt").write_text(body)
    parsed = SF.read_label_texts(spark, [str(tmp_path / f"{n}.txt") for n in parts], "/base")
    K.write_image_list(parsed, str(tmp_path / "list"))
    rows = sorted((r.image_path, r.label) for r in SF.read_image_list(spark, str(tmp_path / "list")).collect())
    assert rows == [("/abs/3.jpg", "5"), ("/base/img/1.jpg", "3"), ("/base/img/1.jpg", "3"), ("/base/img/2.jpg", "4")]
    assert sorted(r.corrupt for r in parsed.filter("corrupt is not null").collect()) == ["a b c", "broken"]


def test_sinks_overwrite(spark, tmp_path):
    for n in (5, 3):
        assert K.write_parquet(spark.range(n), str(tmp_path / "p")) == n
        copy_table(spark.range(n), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id"]
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3


def test_jdbc_without_driver_or_bounds(spark, tmp_path):
    with pytest.raises(ValueError):
        ST.read_table(spark, "jdbc:postgresql://db/x", "t", partition_column="id")
    with pytest.raises(Exception, match="(?i)driver"):
        copy_database_table(spark, "jdbc:postgresql://db/x", "t", str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out")


def test_text_functions(spark):
    row = spark.range(1).select(
        X.base_name(F.lit("hdfs://h/a/b.csv")), X.parent_name(F.lit("hdfs://h/a/b.csv")), X.parent_name(F.lit("b")),
        X.host_of(F.lit("kafka-client:9080")), X.host_of(F.lit("kafka-client")), X.host_of(F.lit("a:b:1")),
        X.video_name(F.lit(7)), X.is_video_name(F.lit("video_07.mp4")), X.is_video_name(F.lit("xvideo_07.mp4")),
        X.is_video_name(F.lit("video_07_mp4")), X.pad_right(F.lit("abc"), 5), X.pad_right(F.lit("abcdef"), 5),
        X.join_path("/base/", F.lit("x")), X.join_path("/base", F.lit("/x")), X.join_path("", F.lit("x")),
    ).first()
    assert list(row) == ["b.csv", "a", None, "kafka-client", None, None, "video_07.mp4", True, False, False,
                         "abc  ", "abcdef", "/base/x", "/x", "x"]


def test_two_decimals_like_python(spark):
    values = [0.125, 0.375, 2.675, 51.665, -0.001, 1234567.891, 1e-9, 0.005, 99.995, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(X.two_decimals(F.col("v"))).collect()] == [f"{v:.2f}" for v in values]
    assert df.select(X.two_decimals(F.lit(None).cast("double"))).first()[0] == "nan"


def test_not_a_number_is_no_value(spark, tmp_path):
    folder = tmp_path / "producer-1"
    folder.mkdir()
    (folder / "CPU.csv").write_text("2024-01-01 00:00:00,1\n2024-01-01 00:00:01,NaN\n2024-01-01 00:00:02,\n2024-01-01 00:00:03,3\n")
    got = SF.read_metric_files(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r["value"] for r in got] == [1.0, None, None, 3.0]


def test_slices_and_blocks_land_in_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from reelmetry.operators import counters as C
    from reelmetry.schemas import FrameShape
    from reelmetry.session import spread_count

    (tmp_path / "video_01.mp4").write_bytes(bytes(48 * 800))
    frames = SF.raw_file_frames(spark, str(tmp_path), FrameShape(4, 4, 3), frames_per_slice=1)
    wanted = spread_count(spark, 800)
    assert frames.count() == 800
    assert frames.select(F.spark_partition_id()).distinct().count() >= wanted // 2
    scraped = spark.sql("SELECT 'a' AS application, 'b' AS instance, 'c' AS job, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 3998) AS ts, "
                        "double(id) AS value FROM range(2)")
    grid = C.scrape_grid(scraped, 2.0, block=1)
    assert grid.count() == 2000


def test_other_name_value_folders_stay_apart(spark):
    paths = ["file:/d/team=a/CPU.csv", "file:/d/job=a/CPU.csv", "/d/producer=a/metric=CPU.csv/part-0-x.csv", "a/x=y.csv", "/d/producer=p=q/metric=m=n.csv/part-1"]
    df = SF.series_of_path(spark.createDataFrame([(p,) for p in paths], "path string"), F.col("path"))
    got = [(r.producer, r.metric) for r in df.collect()]
    assert got == [("team=a", "CPU"), ("job=a", "CPU"), ("a", "CPU"), ("a", "x=y"), ("p=q", "m=n")]
