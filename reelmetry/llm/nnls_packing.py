"""Packing of token sequences by non-negative least squares over length combinations."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelmetry.llm.common import give_back, slices, strings
from reelmetry.llm.token_ids import word_ids
from reelmetry.operators.skew import store_and_release

WINDOW = 2048
#: Lengths per histogram bin of the solver: a window of 2048 has 256 bins, and some 5,600 combinations of up to three fill it.
GRAIN = 8


def combinations(bins: int) -> np.ndarray:
    """All ways to fill a window of ``bins`` with one to three bin sizes, as rows of three (0 for none)."""
    rows = [(bins, 0, 0)] + [(bins - b, b, 0) for b in range(1, bins // 2 + 1)]
    rows += [(a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    return np.array(rows)


def solve_counts(histogram: np.ndarray, ways: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Non-negative repeat counts of the ways whose sums come closest to the histogram (active sets)."""
    size, scale = len(histogram), max(1.0, float(histogram.max(initial=0)))
    target = histogram / scale
    matrix = np.zeros((size, len(ways)))
    for k in range(3):
        np.add.at(matrix, (ways[:, k], np.arange(len(ways))), (ways[:, k] > 0).astype(float))
    usable = np.array([all(histogram[b] > 0 for b in w if b) for w in ways])
    x, active = np.zeros(len(ways)), np.zeros(len(ways), dtype=bool)
    for _ in range(rounds):
        gain = matrix.T @ (target - matrix @ x)
        gain[active | ~usable] = -np.inf
        best = int(gain.argmax())
        if not gain[best] > 1e-9:
            break
        active[best] = True
        while True:
            index = np.flatnonzero(active)
            part = matrix[:, index]
            solved = np.linalg.lstsq(part.T @ part, part.T @ target, rcond=None)[0]
            if (solved > 1e-12).all():
                x[:] = 0
                x[index] = solved
                break
            now = x[index]
            down = solved <= 1e-12
            step = np.min(now[down] / np.maximum(now[down] - solved[down], 1e-300), initial=1.0)
            x[index] = now + step * (solved - now)
            gone = index[(x[index] <= 1e-12) & down] if (x[index] <= 1e-12).any() else index[[int(np.argmin(solved))]]
            x[gone] = 0
            active[gone] = False
            if not active.any():
                break
    return x * scale


@dataclass
class Run:
    """Alike pieces: of the remainders of ``whole`` tokens, those ranked ``low`` to ``high``, from ``start``, ``length`` tokens each."""

    whole: int
    low: int
    high: int
    start: int
    length: int

    @property
    def count(self) -> int:
        return self.high - self.low


class Stock:
    """Runs of pieces by length; pieces are taken from the front."""

    def __init__(self, histogram: dict[int, int]) -> None:
        self.runs: dict[int, list[Run]] = defaultdict(list)
        for length, count in histogram.items():
            self.put(Run(length, 0, count, 0, length))

    def put(self, run: Run) -> None:
        if run.count > 0 and run.length > 0:
            self.runs[run.length].append(run)

    def lengths(self) -> list[int]:
        return sorted(n for n, runs in self.runs.items() if runs)

    def total(self) -> int:
        return sum(r.count * r.length for runs in self.runs.values() for r in runs)

    def first(self, length: int) -> Run:
        """The largest run of a length."""
        return max(self.runs[length], key=lambda r: r.count)

    def take(self, length: int, count: int) -> Run:
        """``count`` pieces of the largest run; it must have as many."""
        run = self.first(length)
        taken = Run(run.whole, run.low, run.low + count, run.start, run.length)
        run.low += count
        if not run.count:
            self.runs[length].remove(run)
        return taken


#: A row of a plan: pieces of a run and where they go: piece ``low + i`` into sequence ``sequence + i`` at ``offset``.
PlanRow = tuple[int, int, int, int, int, int, int]


def plan(histogram: dict[int, int], window: int = WINDOW, grain: int = GRAIN) -> list[PlanRow]:
    """Where every remainder goes: rows (whole, low, high, start, length, sequence, offset).

    The solver's repeat counts, rounded and held to what is there, come first, the
    commonest first. What is left is packed greedily: the longest piece, then the
    longest that fit, and where a gap stays the next piece is cut to fill it. Runs
    of alike pieces are placed at once, so the plan's size depends on the number of
    different lengths, not on the number of documents.
    """
    rows: list[PlanRow] = []
    stock = Stock({n: c for n, c in histogram.items() if 0 < n < window and c > 0})
    sequence = 0

    def place(parts: list[Run], count: int) -> None:
        nonlocal sequence
        offset = 0
        for run in parts:
            rows.append((run.whole, run.low, run.high, run.start, run.length, sequence, offset))
            offset += run.length
        sequence += count

    bins = window // grain
    by_bin = np.zeros(bins + 1)
    for n, c in histogram.items():
        if 0 < n < window:
            by_bin[-(-n // grain)] += c
    ways = combinations(bins)
    counts = solve_counts(by_bin, ways)

    def longest(b: int) -> int | None:
        """The longest length of a bin that is in stock."""
        return next((n for n in range(min(b * grain, window - 1), (b - 1) * grain, -1) if stock.runs.get(n)), None)

    for k in np.argsort(-counts, kind="stable"):
        wanted = round(counts[k])
        if wanted < 1:
            break
        while wanted:
            parts: list[int] = []
            for b in ways[k][ways[k] > 0]:
                n = longest(int(b))
                if n is None:
                    break
                parts.append(n)
            else:
                times = {n: parts.count(n) for n in parts}
                batch = min(wanted, *(stock.first(n).count // t for n, t in times.items()))
                if batch < 1:  # two pieces of one length, the front run has one: from two runs
                    if any(sum(r.count for r in stock.runs[n]) < t for n, t in times.items()):
                        break
                    batch = 1
                place([stock.take(n, batch) for n in parts], batch)
                wanted -= batch
                continue
            break

    while (left := stock.total()) > 0:
        if left <= window:
            place([stock.take(n, 1) for n in reversed(stock.lengths()) for _ in range(sum(r.count for r in stock.runs[n]))], 1)
            break
        # A pattern out of whole runs, then as often as the shortest run allows.
        used: list[tuple[int, int]] = []  # (length, cut to; 0 for whole)
        taken: dict[int, int] = {}
        # Large runs first: they go in few rows, and small ones would break them up.
        most = max(stock.first(n).count for n in stock.lengths())
        have = {n: sum(r.count for r in stock.runs[n] if r.count * 8 >= most) for n in stock.lengths()}
        gap = window
        while gap:
            fits = [n for n in have if n <= gap and have[n] > taken.get(n, 0)]
            if not fits and not any(have[n] > taken.get(n, 0) for n in have):
                have = {n: sum(r.count for r in stock.runs[n]) for n in stock.lengths()}
                continue
            if fits:
                n = max(fits)
                used.append((n, 0))
                gap -= n
            else:
                n = min(n for n in have if have[n] > taken.get(n, 0))
                used.append((n, gap))
                gap = 0
            taken[n] = taken.get(n, 0) + 1
        batch = min(stock.first(n).count // t for n, t in taken.items())
        if batch < 1:
            batch = 1
        parts = []
        for n, cut in used:
            run = stock.take(n, batch)
            if cut:
                stock.put(Run(run.whole, run.low, run.high, run.start + cut, run.length - cut))
                run = Run(run.whole, run.low, run.high, run.start, cut)
            parts.append(run)
        place(parts, batch)
    return rows


_STORED = "row long, doc_id long, part int, n long, remainder int, rank long, windows_before long, ids binary"
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _tokenised(docs: DataFrame, path: str, end_id: int, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = word_ids(path)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        part, row, windows = TaskContext.get().partitionId(), 0, 0
        ranks: dict[int, int] = defaultdict(int)
        for batch in slices(batches, "text"):
            ids = [found + end for found in coder.encode_many(strings(batch.column("text")))]
            n = [len(b) // coder.dtype.itemsize for b in ids]
            left, rank, before = [k % window for k in n], [], []
            for k, rest in zip(n, left, strict=True):
                rank.append(ranks[rest])
                ranks[rest] += 1
                before.append(windows)
                windows += k // window
            keys = np.arange(row, row + len(n), dtype=np.int64) + (part << 36)
            row += len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), batch.column("doc_id"), pa.array([part] * len(n), pa.int32()), pa.array(n, pa.int64()), pa.array(left, pa.int32()),
                 pa.array(rank, pa.int64()), pa.array(before, pa.int64()), pa.array(ids, pa.binary())],
                names=["row", "doc_id", "part", "n", "remainder", "rank", "windows_before", "ids"],
            )
        give_back()

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, _STORED)


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """The ids of all documents, packed into sequences of at most ``window``; one row per piece.

    A document is the ids of its ``text`` by the ``tokenizers`` file at ``path``,
    then ``end_id``. Its whole windows become sequences of their own; the remainders'
    length histogram (at most ``window`` numbers, over all documents) is what the
    driver plans with. A remainder's rank among those of its length is its rank in
    its task plus the counts of the tasks before, so no length meets in one task.

    Returns ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` (negative for a document's whole windows), ``offset``, and
    ``ids`` (little-endian) if asked. Null and empty texts are ``end_id`` alone;
    repeated rows are packed each; other columns are ignored; an empty table gives
    no rows.
    """
    stored = store_and_release(_tokenised(docs, path, end_id, window), "ids")
    light = stored.select("row", "part", "remainder", "rank", "n").where("remainder > 0")
    per_part = light.groupBy("part", "remainder").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("remainder").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_part = store_and_release(per_part.withColumn("before", before), "ranks")
    histogram = {r["remainder"]: r["rows"] for r in per_part.groupBy("remainder").agg(F.sum("rows").alias("rows")).collect()}
    spark = docs.sparkSession
    rows = spark.createDataFrame(
        plan(histogram, window), "remainder int, low long, high long, piece_start int, length int, sequence_id long, offset int")
    ranked = light.join(per_part.drop("rows"), ["part", "remainder"]).withColumn("rank", F.col("rank") + F.col("before"))
    # The plan has a few rows per length, whatever the input.
    placed = ranked.join(F.broadcast(rows), "remainder").where("rank >= low AND rank < high")
    sequence = (F.col("sequence_id") + F.col("rank") - F.col("low")).alias("sequence_id")
    piece = F.struct(F.col("piece_start").alias("start"), "length", sequence, "offset")
    placed = placed.groupBy("row").agg(F.collect_list(piece).alias("pieces"))
    joined = stored.select("row", "doc_id", "part", "n", "windows_before", "ids").join(placed.hint("shuffle_hash"), "row", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            # Rows of whole windows have no piece of the plan.
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "part", "n", "windows_before", "ids", "pieces")]
            for doc_id, part, n, windows, ids, pieces in zip(*columns, strict=True):
                full = n // window
                wide = len(ids) // n  # bytes an id; asking the tokenizer would load it into the driver
                places = [(i * window, window, -1 - ((part << 40) + windows + i), 0) for i in range(full)]
                places += [(full * window + p["start"], p["length"], p["sequence_id"], p["offset"]) for p in pieces or ()]
                for start, length, sequence, offset in places:
                    own = ids[start * wide : (start + length) * wide]
                    crc = zlib.crc32(np.frombuffer(own, dtype=f"<u{wide}").astype("<u4"))
                    for column, value in zip(out, (doc_id, start, length, crc, n, sequence, offset, own if with_ids else None), strict=True):
                        column.append(value)
            arrays = [pa.array(c, pa.int64()) for c in out[:7]] + ([pa.array(out[7], pa.binary())] if with_ids else [])
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        give_back()

    return joined.mapInArrow(cut, _PIECE + ", ids binary" * with_ids)
