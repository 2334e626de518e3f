"""Chunked windows against pandas, with one series that holds most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelmetry.operators.ordered import (
    CHUNK, centred_mean, cut, cut_regular, last_known, next_known, number_in_order, position, previous, running_total,
)
from reelmetry.operators.quantiles import exact_quantile
from reelmetry.operators.series import ordered_files


@pytest.fixture(scope="module")
def rows():
    """600 rows, 400 of them in series ``hot``; a fifth of the values are null,
    with null runs longer than a chunk at the start and in the middle."""
    rng = np.random.default_rng(3)
    keys = np.array(["hot"] * 400 + ["a"] * 150 + ["b"] * 49 + ["one"])
    rng.shuffle(keys)
    frame = pd.DataFrame({"key": keys, "seq": np.arange(600) * 3, "value": rng.normal(size=600).round(3)})
    frame.loc[rng.random(600) < 0.2, "value"] = np.nan
    frame.loc[(frame.key == "hot") & (frame.index < 90), "value"] = np.nan
    frame.loc[(frame.key == "hot") & frame.index.to_series().between(300, 400), "value"] = np.nan
    return frame


def spark_rows(spark, rows):
    data = [(r.key, int(r.seq), None if np.isnan(r.value) else float(r.value)) for r in rows.itertuples()]
    return spark.createDataFrame(data, "key string, seq long, value double").repartition(5)


def collected(df):
    return df.toPandas().sort_values("seq").reset_index(drop=True)


def same(left, right):
    np.testing.assert_allclose(left.astype(float).to_numpy(), right.astype(float).to_numpy(), atol=1e-9)


@pytest.mark.parametrize("target", [10_000, 50, 7])
def test_operations_match_pandas(spark, rows, target):
    df = spark_rows(spark, rows)
    series = cut(df, ["key"], "seq", target)
    assert series.single == (target == 10_000)
    got = collected(
        series.run(position("pos"), previous("value", "prev"), last_known("value", "back"))
        .run(next_known("value", "ahead")).result()
    )
    assert CHUNK not in got.columns and len(got) == len(rows)
    grouped = rows.groupby("key")
    same(got.pos, grouped.cumcount())
    same(got.prev, grouped["value"].shift())
    same(got.back, grouped["value"].ffill())
    same(got.ahead, grouped["value"].bfill())


def test_running_total(spark, rows):
    df = spark_rows(spark, rows).withColumn("value", F.coalesce("value", F.lit(0.0)))
    got = collected(cut(df, ["key"], "seq", 40).run(running_total("value", "total")).result())
    same(got.total, rows.fillna({"value": 0.0}).groupby("key")["value"].cumsum())


def test_chunks_are_bounded_for_bunched_order(spark):
    """Nine tenths of the rows lie in a thousandth of the time range."""
    df = spark.range(2000).select(
        F.lit("s").alias("key"),
        F.when(F.col("id") < 1800, F.col("id")).otherwise(F.col("id") * 1000).alias("seq"),
        F.lit(1.0).alias("value"),
    )
    sizes = cut(df, ["key"], "seq", 100).df.groupBy(CHUNK).count().toPandas()["count"]
    assert sizes.max() <= 150 and sizes.sum() == 2000


def test_only_long_series_are_cut(spark, rows):
    df = spark_rows(spark, rows)
    chunks = cut(df, ["key"], "seq", 100).df.groupBy("key").agg(F.countDistinct(CHUNK).alias("n")).collect()
    got = {r.key: r.n for r in chunks}
    assert got["hot"] > 2 and got["a"] > 1 and got["b"] == 1 and got["one"] == 1
    assert cut(df, ["key"], "seq", 400).single and not cut(df, ["key"], "seq", 399).single


def test_cut_regular(spark):
    df = spark.range(100).select(F.lit("s").alias("key"), F.col("id").alias("seq"),
                                 F.when(F.col("id") % 30 == 0, F.col("id")).alias("value"))
    got = collected(cut_regular(df, ["key"], "seq", F.col("seq"), 8).run(last_known("value", "value")).result())
    assert got.value.tolist() == [30 * (i // 30) for i in range(100)]


@pytest.mark.parametrize("period", [30, 4, 5, 1])
@pytest.mark.parametrize("block", [1_000_000, 64, 31])
def test_centred_mean(spark, period, block):
    rng = np.random.default_rng(5)
    values = {"x": rng.normal(size=200), "y": rng.normal(size=33), "z": rng.normal(size=3)}
    data = [(k, i, float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "key string, pos long, value double")
    got = centred_mean(df, ["key"], "pos", "value", period, "mean", block).toPandas()
    assert len(got) == len(data)
    half = period // 2
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period if period % 2 == 0 else np.ones(period) / period
    for key, vs in values.items():
        expected = np.full(len(vs), np.nan)
        for i in range(half, len(vs) - half):
            expected[i] = (vs[i - half: i + half + 1] * weights).sum()
        same(got[got.key == key].sort_values("pos")["mean"], pd.Series(expected))


@pytest.mark.parametrize("target", [10_000, 60, 9])
@pytest.mark.parametrize("q", [0.0, 0.37, 0.9, 0.99, 1.0])
def test_exact_quantile(spark, rows, target, q):
    frame = rows.copy()
    frame.loc[frame.key == "a", "value"] = np.tile([1.5, 1.5, 2.0], 50)  # heavy ties
    got = exact_quantile(spark_rows(spark, frame), ["key"], "value", q, "v", target).toPandas().set_index("key")["v"]
    expected = frame.groupby("key")["value"].quantile(q).dropna()
    assert sorted(got.index) == sorted(expected.index)
    same(got.sort_index(), expected.sort_index())


def test_exact_quantile_bound_skips_the_sketch(spark, rows):
    df = spark_rows(spark, rows)
    got = exact_quantile(df, ["key"], "value", 0.5, "v", 1000, bound=df).toPandas().set_index("key")["v"]
    same(got.sort_index(), rows.groupby("key")["value"].quantile(0.5).dropna().sort_index())


def test_ordered_files_by_name(spark):
    names = [("big", f"img_{(i * 37) % 900:04d}.JPG") for i in range(900)] + [("small", n) for n in ("b", "a", "ä")]
    df = spark.createDataFrame(names, "folder string, name string").repartition(4)
    for target in (10_000, 100):
        got = ordered_files(df, target_rows=target).toPandas()
        for folder, group in got.groupby("folder"):
            assert group.sort_values("frame_seq").name.tolist() == sorted(n for f, n in names if f == folder)
            assert sorted(group.frame_seq) == list(range(len(group)))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_numbers_in_order_of_skewed_names(spark, partitions):
    """One folder and one long prefix hold nearly all names; a folder's numbers have no gap, whatever the tasks."""
    names = [("hot", "a" * 200 + f"{i:05d}") for i in range(3000)] + [("hot", n) for n in ("b", "", "ä", "日")]
    names += [(f"f{i}", str(j)) for i in range(40) for j in range(i)] + [("hot", None), (None, "x")]
    df = spark.createDataFrame(names, "folder string, name string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = number_in_order(df, ["folder"], "name", "pos").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(names) - 1
    for folder in {f for f, _ in names if f}:
        own = sorted((r.pos, r.name) for r in got if r.folder == folder)
        wanted = sorted((n for f, n in names if f == folder), key=lambda n: (n is not None, (n or "").encode()))
        assert own == list(enumerate(wanted))


@pytest.mark.parametrize("target", [10_000, 40])
def test_a_row_without_an_order_comes_first(spark, target):
    """One window or chunks: the row without an order is the one before the first."""
    rows = [("k", None, 90.0)] + [("k", i, float(i) if i > 2 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, seq long, value double")
    series = cut(df, ["key"], "seq", target).run(previous("value", "prev"), last_known("value", "back"), next_known("value", "ahead"), position("pos"))
    got = {r.seq: (r.prev, r.back, r.ahead, r.pos) for r in series.result().collect()}
    assert got[None] == (None, 90.0, 90.0, 0)
    assert got[0] == (90.0, 90.0, 3.0, 1) and got[1] == (None, 90.0, 3.0, 2) and got[4] == (3.0, 4.0, 4.0, 5)
