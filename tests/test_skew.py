"""Joins behind size checks; plans without cross joins or whole-series tasks."""

import re

import pytest
from pyspark.sql import functions as F

from reelmetry.operators import skew
from reelmetry.operators.series import wide_table
from reelmetry.session import scratch_path, shared_dir


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [100, 2])
def test_attach_small(spark, limit):
    big = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    fits = skew.few_groups(small, ["k"], limit)
    assert fits == (limit == 100)
    got = skew.attach_small(big, small, ["k"], fits=fits, spread_by="id", salts=8)
    expected = big.join(small, "k")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert ("_salt" in plan_of(got)) == (not fits)
    assert not fits or "BroadcastExchange" in plan_of(got)


@pytest.mark.parametrize("limit", [100, 2])
def test_keep_listed(spark, limit):
    listed = spark.createDataFrame([(i * 7,) for i in range(20)], "id long")
    got = skew.keep_listed(spark.range(100), listed, ["id"], limit)
    assert sorted(r.id for r in got.collect()) == [i * 7 for i in range(15)]


def test_rows_within(spark):
    assert skew.rows_within(spark.range(5), 5) and not skew.rows_within(spark.range(6), 5)


def test_store_round_trip(spark):
    stored = skew.store(spark.range(10), "ten")
    assert stored.count() == 10 and shared_dir(spark) in stored.inputFiles()[0]
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_chunked_fill_shuffles_the_aligned_table_once(spark):
    """Both sides of the carry join read one shuffle of the aligned rows."""
    samples = spark.range(4000).select(
        F.element_at(F.split(F.lit("a,b,c"), ","), (F.col("id") % 3 + 1).cast("int")).alias("producer"), F.when(F.col("id") % 2 == 0, F.lit("CPU")).otherwise(F.lit("Memory")).alias("metric"),
        F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("ts"),
        F.col("id").cast("double").alias("value"), F.col("id").alias("seq"),
    )
    wide = wide_table(samples, ["CPU", "Memory"], target_rows=500)
    assert wide.count() == 4000
    wide.collect()
    plan = plan_of(wide).split("Initial Plan")[0]
    assert len(re.findall(r"ReusedExchange \[.*?\], Exchange hashpartitioning\(producer#\d+, ts#", plan)) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
