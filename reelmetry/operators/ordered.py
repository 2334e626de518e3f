"""Ordered operations over series that may be too long for one task.

A plain ``Window.partitionBy(series)`` puts a whole series into one task. Here
long series are first cut into consecutive *chunks* along the ordering column,
with cut points taken from a quantile sketch, so that a chunk holds a bounded
number of rows however the data is skewed. Windows then run per
(series, chunk), and what must flow from one chunk to the next (a row offset,
a last known value) travels through a small table with one row per
(series, chunk).

When every series fits one task the plain window is used: no carry table, no join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from reelmetry.operators.skew import BROADCAST_ROWS, store

#: Rows that one window task may be given.
TARGET_ROWS = 2_000_000

#: Most chunks along the order: bounds the sketch, the cut points and the carry
#: table of a series. Beyond, chunks grow: 10**12 rows in long series make chunks
#: of 5 * 10**7 rows, all series together.
MAX_CHUNKS = 20_000

CHUNK = "_chunk"
_NUMERIC = "_order_number"
_PLACE, _ID, _TASK = "_place", "_row_id", "_task"


def _order_number(df: DataFrame, order: str) -> Column:
    kind = df.schema[order].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    return F.col(order).cast("double")


@dataclass(frozen=True)
class Step:
    """One ordered operation, in the four parts that chunked running needs."""

    name: str
    #: value from the rows of the chunk alone, over the window it is given
    local: Callable[[WindowSpec], Column]
    #: what a chunk passes on, an aggregate over its rows ordered by the named column
    passed_on: Callable[[str], Column]
    #: what reaches a chunk, from the passed-on values of the others
    reaching: Callable[[Column, WindowSpec], Column]
    #: the result from the local and the reaching value (null in a first chunk)
    combine: Callable[[Column, Column], Column]


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def position(name: str = "pos") -> Step:
    """0-based row position in the series."""
    return Step(
        name,
        lambda w: (F.row_number().over(w) - 1).cast("long"),
        lambda order: F.count("*"),
        lambda n, w: F.sum(n).over(_before(w)),
        lambda local, offset: local + F.coalesce(offset, F.lit(0)),
    )


def running_total(value: str, name: str) -> Step:
    """Sum of ``value`` up to and with each row."""
    return Step(
        name,
        lambda w: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        lambda order: F.sum(value),
        lambda total, w: F.sum(total).over(_before(w)),
        lambda local, offset: local + F.coalesce(offset, F.lit(0)),
    )


def previous(value: str, name: str) -> Step:
    """The value one row earlier, null included; null in the first row."""
    return Step(
        name,
        lambda w: F.struct(F.row_number().over(w).alias("n"), F.lag(value).over(w).alias("v")),
        # Rows without an order come first and have a chunk of their own.
        lambda order: F.coalesce(F.max_by(value, order), F.max(F.when(F.col(order).isNull(), F.col(value)))),
        lambda last, w: F.lag(last).over(w),
        lambda local, edge: F.when(local["n"] == 1, edge).otherwise(local["v"]),
    )


def last_known(value: Column | str, name: str) -> Step:
    """Nearest non-null value at or before each row."""
    value = F.col(value) if isinstance(value, str) else value
    return Step(
        name,
        lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        lambda order: F.coalesce(F.max_by(value, F.when(value.isNotNull(), F.col(order))), F.max(F.when(F.col(order).isNull(), value))),
        lambda last, w: F.last(last, ignorenulls=True).over(_before(w)),
        lambda local, edge: F.coalesce(local, edge),
    )


def next_known(value: Column | str, name: str) -> Step:
    """Nearest non-null value at or after each row."""
    value = F.col(value) if isinstance(value, str) else value
    return Step(
        name,
        lambda w: F.first(value, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        lambda order: F.coalesce(F.min_by(value, F.when(value.isNotNull(), F.col(order))), F.min(F.when(F.col(order).isNull(), value))),
        lambda first, w: F.first(first, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
        lambda local, edge: F.coalesce(local, edge),
    )


@dataclass(frozen=True)
class OrderedSeries:
    """Rows of many series, cut into chunks along ``order``."""

    df: DataFrame
    keys: tuple[str, ...]
    order: str
    single: bool

    def run(self, *steps: Step) -> OrderedSeries:
        """Add the result column of every step, all in one pass.

        Partial aggregation shrinks each chunk to one row before the shuffle, so
        the windows along the chunks see only as many rows as there are chunks.
        """
        parts = list(self.keys) if self.single else [*self.keys, CHUNK]
        within = Window.partitionBy(*parts).orderBy(self.order)
        local = {f"_l{i}": step.local(within) for i, step in enumerate(steps)}
        rows = self.df.withColumns(local)
        if self.single:
            results = {s.name: s.combine(F.col(f"_l{i}"), F.lit(None)) for i, s in enumerate(steps)}
        else:
            along = Window.partitionBy(*self.keys).orderBy(CHUNK)
            summary = self.df.groupBy(*parts).agg(
                *[step.passed_on(self.order).alias(f"_p{i}") for i, step in enumerate(steps)]
            )
            carry = summary.select(
                *parts, *[step.reaching(F.col(f"_p{i}"), along).alias(f"_r{i}") for i, step in enumerate(steps)]
            )
            rows = rows.join(carry, parts, "left")
            results = {s.name: s.combine(F.col(f"_l{i}"), F.col(f"_r{i}")) for i, s in enumerate(steps)}
        rows = rows.withColumns(results).drop(*local, *[f"_r{i}" for i in range(len(steps))])
        return OrderedSeries(rows, self.keys, self.order, self.single)

    def result(self) -> DataFrame:
        return self.df if self.single else self.df.drop(CHUNK)


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that have a key. The carry joins would infer this filter for one
    side only, and then the two sides could not share one shuffle."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def cut(df: DataFrame, keys: Sequence[str], order: str, target_rows: int = TARGET_ROWS,
        profile: DataFrame | None = None) -> OrderedSeries:
    """Cut every series of more than ``target_rows`` rows into chunks.

    ``order`` must be unique within a series; rows without a key belong to no
    series and drop out. Row counts decide whether cutting is needed and for
    which series; only then does a quantile sketch over ``order`` (one pruned
    column, bounded state) supply the cut points. Series that fit a task stay
    whole, so the carry table has a row for each of them and one per chunk of
    the long ones.

    ``profile`` is the frame to count and sketch when ``df`` is costly to
    compute: it must have the keys and the ``order`` column, and at least the
    rows of ``df`` in every series.
    """
    keys = tuple(keys)
    df = _keyed(df, keys)
    profile = df if profile is None else _keyed(profile, keys)
    whole = OrderedSeries(df, keys, order, single=True)
    rows = profile.count()
    if rows <= target_rows:
        return whole
    long_series = None
    if rows / target_rows <= BROADCAST_ROWS:  # a proven bound on the number of long series
        counted = profile.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > target_rows)
        found = counted.collect()
        if not found:
            return whole
        long_series = df.sparkSession.createDataFrame(found, counted.schema).drop("_n")
        profile = profile.join(F.broadcast(long_series), list(keys), "left_semi")
        rows = sum(row["_n"] for row in found)
    pieces = min(math.ceil(rows / target_rows), MAX_CHUNKS)
    if profile.schema[order].dataType.typeName() == "string":
        numbered = number_in_order(df, keys, order, _PLACE)
        return OrderedSeries(cut_regular(numbered, keys, order, F.col(_PLACE), target_rows).df.drop(_PLACE), keys, order, single=False)
    chunked = _chunk_numbers(df, order, profile, pieces)
    if chunked is None:
        return whole
    # Never null, so the joins on it add no filter that would keep Spark from
    # reusing the shuffle under both join sides.
    chunk = F.coalesce(F.col(CHUNK).cast("int"), F.lit(-1))
    if long_series is not None:
        chunked = chunked.join(F.broadcast(long_series.withColumn("_long", F.lit(True))), list(keys), "left")
        chunk = F.when(F.col("_long"), chunk).otherwise(F.lit(-1))
    return OrderedSeries(chunked.withColumn(CHUNK, chunk).drop("_long"), keys, order, single=False)


def _chunk_numbers(df: DataFrame, order: str, profile: DataFrame, pieces: int) -> DataFrame | None:
    probabilities = [i / pieces for i in range(1, pieces)]
    points = profile.select(_order_number(profile, order).alias(_NUMERIC)).approxQuantile(
        _NUMERIC, probabilities, 1 / (10 * pieces)
    )
    splits = [-math.inf, *sorted(set(points)), math.inf]
    if len(splits) < 3:
        return None
    bucketizer = Bucketizer(splits=splits, inputCol=_NUMERIC, outputCol=CHUNK, handleInvalid="keep")
    return bucketizer.transform(df.withColumn(_NUMERIC, _order_number(df, order))).drop(_NUMERIC)


def number_in_order(df: DataFrame, keys: Sequence[str], order: str, name: str = "pos") -> DataFrame:
    """0-based row position in each series, for an order of any type and series of any length.

    The rows are dealt by ranges of (keys, order) and sorted, so a long series lies
    in consecutive tasks and a row's number in its task is at hand. The numbered rows
    are stored once. A table of one row per series and task it touches gives the
    rows before; no list of cut points is part of an expression. Rows without a key
    drop out, rows without an order come first.
    """
    keys = list(keys)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = _keyed(df, keys).repartitionByRange(tasks, *keys, order).sortWithinPartitions(*keys, order)
    # The id is the task's number in the high bits and the row's in the lower 33.
    rows = store(dealt.withColumn(_ID, F.monotonically_increasing_id()), "numbered").withColumn(_TASK, F.shiftright(_ID, 33))
    runs = rows.groupBy(*keys, _TASK).agg(F.min(_ID).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(_before(Window.partitionBy(*keys).orderBy(_TASK))), F.lit(0))
    offsets = runs.select(*keys, _TASK, (before - F.col("_first")).alias("_offset"))
    return rows.join(offsets, [*keys, _TASK]).withColumn(name, F.col(_ID) + F.col("_offset")).drop(_ID, _TASK, "_offset")


def cut_regular(df: DataFrame, keys: Sequence[str], order: str, step: Column,
                target_rows: int = TARGET_ROWS) -> OrderedSeries:
    """Cut gapless rows by their number ``step``: exact chunks, nothing to measure."""
    chunk = F.floor(step / target_rows).cast("int")
    return OrderedSeries(_keyed(df, keys).withColumn(CHUNK, F.coalesce(chunk, F.lit(-1))), tuple(keys), order, single=False)


def centred_mean(df: DataFrame, keys: Sequence[str], pos: str, value: str, period: int,
                 name: str = "trend", block_rows: int = TARGET_ROWS) -> DataFrame:
    """Centred moving average by row position (0-based, gapless ``pos``).

    An even period takes ``period + 1`` rows with half weight on both ends; an
    odd one takes ``period`` rows. Rows without a full window get null.

    Rows are grouped in blocks of ``block_rows`` positions, and the rows within
    half a period of a block's edge are also sent to the neighbouring block.
    """
    half = period // 2
    position = F.col(pos)
    home = F.floor(position / block_rows)
    blocks = F.array_distinct(F.array(
        home, F.floor((position - half) / block_rows), F.floor((position + half) / block_rows)
    ))
    spread = df.withColumn("_block", F.explode(blocks))
    w = Window.partitionBy(*keys, "_block").orderBy(pos)
    frame = w.rowsBetween(-half, half)
    total = F.sum(value).over(frame)
    if period % 2 == 0:
        total = total - 0.5 * (F.lag(value, half).over(w) + F.lead(value, half).over(w))
    full = F.count(value).over(frame) == 2 * half + 1
    averaged = spread.withColumn(name, F.when(full, total / period))
    return averaged.filter(F.col("_block") == home).drop("_block")
