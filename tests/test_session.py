"""The shared folder and the sizing of shuffles."""

from types import SimpleNamespace

from reelmetry import session


def fake(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured, set=lambda key, value: None),
        sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key: None)),
    )


def test_shared_folder_comes_from_the_session():
    assert session.shared_dir(fake("spark://host:7077", "hdfs://name/scratch")) == "hdfs://name/scratch"
    assert session.scratch_path(fake("yarn", "hdfs://name/scratch/"), "wide").startswith("hdfs://name/scratch/wide-")


def test_without_the_setting_the_warehouse_is_shared(spark):
    plain = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.sql.warehouse.dir": "hdfs://name/house/"}.get(key, default)),
                            sparkContext=SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda key: None)))
    assert session.shared_dir(plain) == "hdfs://name/house/_scratch"


def test_small_pieces_are_spread(spark):
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    assert session.spread_count(spark, 1) == 1 and session.spread_count(spark, 800) == wanted


def test_shuffle_partitions():
    assert session.shuffle_partitions(1) == 200
    assert session.shuffle_partitions(100 * 2**40 // 4) == 102_400
    assert session.shuffle_partitions(10**18) == session.MOST_PARTITIONS
