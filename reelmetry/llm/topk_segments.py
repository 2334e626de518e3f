"""Exact top-k search by inner product with multi-resolution segment statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelmetry.operators.skew import store

#: Components per segment at each level, coarse to fine. Segments of two know both values, but not which is which.
SEGMENT_SIZES = (32, 8, 4, 2)
#: A level that drops less than this share of the pairs it sees is passed over for so many steps.
LEAST_DROPPED, PASSED_STEPS = 0.02, 32
#: Products up to this are exact in doubles. Vectors whose products may exceed a long take no part.
EXACT, LARGEST = 2.0**53, 2.0**62
#: Vectors of the bounded sample that gives the first score thresholds.
SEED_ROWS = 2048
#: Bytes of queries sent to the tasks at once; more queries go in several passes over the candidates.
QUERY_BYTES = 32 << 20
#: Pairs compared at a time.
STEP_PAIRS = 1 << 20


def integers(vector: str = "embedding", scale: int = 1024) -> Column:
    """floor(scale * x) for every component, as double."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))


def usable(vector: str = "embedding", scale: int = 1024) -> Column:
    """No null vector, no null or non-finite component, not empty, and none so large that a product with its like exceeds a long."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    most = F.array_max(F.transform(F.col(vector), lambda x: F.abs(x.cast("double")))) * scale + 1
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad & (most * most * F.size(vector) < LARGEST), F.lit(False))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """For each row, sqrt(length) times the mean and the deviation of every segment.

    The inner product of two rows of such statistics is at least that of the
    vectors. With d2 the sum over segments of length * ((difference of means)**2 +
    (difference of deviations)**2), d2 is a lower bound of the squared distance,
    and (|q|**2 + |x|**2 - d2) / 2 comes to just that product.
    """
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    sizes = np.diff(cuts)
    means = np.add.reduceat(x, cuts[:-1], axis=1) / sizes
    rest = x - np.repeat(means, sizes, axis=1)
    deviations = np.sqrt(np.add.reduceat(rest * rest, cuts[:-1], axis=1) / sizes)
    return np.concatenate([means, deviations], axis=1) * np.sqrt(np.concatenate([sizes, sizes]))


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of each query's k best pairs: score down, id up; in order of the query."""
    order = np.lexsort((ids, -scores, query))
    q = query[order]
    first = np.concatenate([[0], np.flatnonzero(q[1:] != q[:-1]) + 1]) if len(q) else np.empty(0, dtype=int)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[rank < k]


def levels_of(size: int) -> list[int]:
    """Numbers of segments for vectors of ``size`` components, coarse to fine."""
    return sorted({max(1, size // n) for n in SEGMENT_SIZES})


class Search:
    """One block of queries against candidates that come in steps."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, thresholds: np.ndarray | None = None) -> None:
        self.ids, self.vectors, self.k = ids, vectors.astype(float), k
        self.levels = levels_of(vectors.shape[1])
        self.statistics = [segment_statistics(self.vectors, n) for n in self.levels]
        self.least = np.full(len(ids), -np.inf) if thresholds is None else thresholds.astype(float).copy()
        self.most = np.abs(self.vectors).max(initial=0)
        self.found = [np.empty(0, dtype=np.int64)] * 3  # query index, candidate id, score
        self.passed = [0] * len(self.levels)
        #: Pairs that came, and those left after each level.
        self.pairs, self.left = 0, [0] * len(self.levels)

    def _survivors(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Candidates x queries: whether the bound of every level reaches the query's threshold (ties do).

        A level is one product of small matrices for all pairs. Levels that dropped
        next to nothing are passed over for some steps; the finest always counts.
        """
        slack = self.least - 1e-6 * (1 + np.abs(self.least))
        alive = ids[:, None] != self.ids[None, :]
        self.pairs += int(alive.sum())
        for i, n in enumerate(self.levels):
            if self.passed[i] and i < len(self.levels) - 1:
                self.passed[i] -= 1
                self.left[i] += int(alive.sum())
                continue
            before = int(alive.sum())
            alive &= segment_statistics(vectors, n) @ self.statistics[i].T >= slack
            after = int(alive.sum())
            self.left[i] += after
            if before and before - after < LEAST_DROPPED * before:
                self.passed[i] = PASSED_STEPS
            if not after:
                break
        return alive

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Candidates, some at a time, so that the pairs' bounds take little room."""
        step = max(16, STEP_PAIRS // max(len(self.ids), 1))
        for at in range(0, len(ids), step):
            self._step(ids[at : at + step], vectors[at : at + step])

    def _step(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Bounds level by level, then exact products of what survives, query by query."""
        floats = vectors.astype(float)
        alive = self._survivors(ids, floats)
        exact = self.most * np.abs(floats).max(initial=0) * floats.shape[1] < EXACT
        left = floats if exact else vectors.astype(np.int64)
        right = self.vectors if exact else self.vectors.astype(np.int64)
        queries, candidates, scores = [self.found[0]], [self.found[1]], [self.found[2]]
        for q in np.flatnonzero(alive.any(axis=0)):
            own = np.flatnonzero(alive[:, q])
            product = left[own] @ right[q]
            high = np.flatnonzero(product >= self.least[q])
            queries.append(np.full(len(high), q, dtype=np.int64))
            candidates.append(ids[own[high]])
            scores.append(product[high].astype(np.int64))
        joined = [np.concatenate(x) for x in (queries, candidates, scores)]
        best = _best(*joined, self.k)
        self.found = [x[best] for x in joined]
        query, _, scores = self.found
        if len(query):
            last = np.flatnonzero(np.append(query[1:] != query[:-1], True))
            full = np.bincount(query, minlength=len(self.ids))[query[last]] >= self.k
            at = query[last][full]
            self.least[at] = np.maximum(self.least[at], scores[last][full])


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _scan(candidates: DataFrame, query_ids: np.ndarray, queries: np.ndarray, seed: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """Each task's best pairs for one block of queries."""
    search = Search(query_ids, queries, k)
    if len(seed[0]):
        search.add(*seed)
    shared = candidates.sparkSession.sparkContext.broadcast((query_ids, queries, search.least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Search(*shared.value[:2], k, shared.value[2])
        for batch in batches:
            own.add(batch.column("vec_id").to_numpy(), _matrix(batch.column("v")))
        query, ids, scores = own.found
        if len(query):
            yield pa.RecordBatch.from_arrays([pa.array(own.ids[query]), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return candidates.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 10, query: Column | None = None, scale: int = 1024) -> DataFrame:
    """The ``k`` highest integer inner products of every query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``vectors`` has ``vec_id`` and ``embedding``; queries are the rows for which
    ``query`` holds (``vec_id`` divisible by 100 unless given), candidates all rows
    but those of the query's own ``vec_id``. Ties go to the smaller ``vec_id``. Rows
    with a null id take no part, nor vectors that are null, empty, hold null or
    non-finite components, or components so large that a product with a vector of
    such ones would exceed a long; only vectors of equal length are compared.
    Repeated rows are candidates each; vectors that share a query's id share its
    ranking. Other columns are ignored; no queries give no rows.

    Means and deviations of few, then more segments give lower bounds of distances,
    that is upper bounds of products, which drop most candidates; the rest are
    multiplied exactly. The first thresholds come from a sample of at most
    SEED_ROWS vectors (they only save work). Queries travel in blocks of a bounded
    size, one pass over the candidates each.
    """
    query = F.col("vec_id") % 100 == 0 if query is None else query
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(usable(scale=scale) & F.col("vec_id").isNotNull())
    asked = rows.where(query).select("vec_id", integers(scale=scale).alias("v"))
    candidates = rows.select("vec_id", integers(scale=scale).alias("v"))
    sizes = {r["size"]: r["rows"] for r in asked.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    spark = vectors.sparkSession
    parts = []
    for size, count in sorted(sizes.items()):
        alike = candidates.where(F.size("v") == size)
        sample = alike.orderBy(F.xxhash64("vec_id")).limit(SEED_ROWS).toPandas()
        seed = (sample["vec_id"].to_numpy(), np.stack(sample["v"].to_list())) if len(sample) else (np.empty(0, np.int64), None)
        blocks = -(-count * size * 8 // QUERY_BYTES)
        for b in range(blocks):
            block = asked.where((F.size("v") == size) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)).distinct().toPandas()
            if len(block):
                found = _scan(alike, block["vec_id"].to_numpy(), np.stack(block["v"].to_list()), seed, k)
                parts.append(store(found, "pairs") if blocks > 1 else found)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pairs = parts[0]
    for p in parts[1:]:
        pairs = pairs.unionByName(p)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
