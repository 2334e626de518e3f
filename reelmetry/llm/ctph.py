"""Document fingerprints by context-triggered piecewise hashing, and their likeness."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.llm.common import U64, constants, mix, slices, strings
from reelmetry.operators.skew import store

ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
#: Bytes that decide about a boundary, the smallest block size, the signature length aimed at.
CONTEXT, LEAST_BLOCK, SIGNATURE = 7, 3, 64
#: Signatures that share no run of so many characters are unlike.
SHARED_RUN = 7
#: Bytes of a text walked at a time.
PIECE = 1 << 20
_MULTIPLIER = 0x5851F42D4C957F2D


def _table() -> np.ndarray:
    return constants(256, 101)


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the last CONTEXT bytes at every byte (fewer at the start)."""
    table, factors = _table(), constants(CONTEXT, 103)
    values = table[data]
    out = values * factors[0]
    for j in range(1, CONTEXT):
        out[j:] += values[:-j] * factors[j]
    return mix(out) >> U64(32)


def _signature(chunk_ends: np.ndarray, sums: np.ndarray, inverse: np.ndarray, size: int) -> str:
    """One character per chunk; chunks beyond the last place share it."""
    ends = chunk_ends[: SIGNATURE - 1]
    if not len(ends) or ends[-1] != size:
        ends = np.append(ends, size)
    starts = np.concatenate([[0], ends[:-1]])
    before = np.where(starts > 0, sums[starts - 1], U64(0))
    hashes = mix((sums[ends - 1] - before) * inverse[starts])
    return ALPHABET[(hashes >> U64(58)).astype(np.int64)].tobytes().decode()


class _Powers:
    """Powers of a multiplier and its inverse modulo 2**64, as long as the longest text so far, PIECE at most."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size, p = max(n, 1 << 16), _MULTIPLIER
            up, down = np.full(size, p, dtype=U64), np.full(size, pow(p, -1, 1 << 64), dtype=U64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _long_ends(data: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks of a long text end at a block size and at twice it, found piece by piece."""
    single, double = [], []
    for at in range(0, len(data), PIECE):
        first = max(at - CONTEXT + 1, 0)  # the hash of a byte looks at those before it
        rolling = _rolling(data[first : at + PIECE])[at - first :]
        single.append(np.flatnonzero(rolling % U64(block) == U64(block - 1)) + at + 1)
        double.append(np.flatnonzero(rolling % U64(2 * block) == U64(2 * block - 1)) + at + 1)
    return np.concatenate(single), np.concatenate(double)


def _long_signature(data: np.ndarray, chunk_ends: np.ndarray) -> str:
    """``_signature`` of a long text, every chunk's hash summed piece by piece."""
    ends = chunk_ends[: SIGNATURE - 1].tolist()
    if not ends or ends[-1] != len(data):
        ends.append(len(data))
    up, _ = _POWERS.upto(PIECE)
    sums, start = [], 0
    for end in ends:
        total = np.zeros(1, dtype=U64)
        for at in range(start, end, PIECE):
            part = _table()[data[at : min(at + PIECE, end)]]
            total += np.sum(part * up[: len(part)], dtype=U64, keepdims=True) * np.array([pow(_MULTIPLIER, at - start, 1 << 64)], dtype=U64)
        sums.append(total[0])
        start = end
    hashes = mix(np.array(sums, dtype=U64))
    return ALPHABET[(hashes >> U64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block`` of a whole text; ``3::`` of an empty one.

    A chunk ends where the rolling hash of the last bytes has a remainder that the
    block size fixes, so a change moves only the boundaries near it. The block
    size is the smallest 3 * 2**k that would give at most 64 chunks, halved while
    the signature has fewer than 32. Texts above PIECE bytes are walked in pieces,
    so little more than the text is held.
    """
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    size = len(data)
    if not size:
        return f"{LEAST_BLOCK}::"
    block = LEAST_BLOCK
    while block * SIGNATURE < size:
        block *= 2
    if size > PIECE:
        found, double = _long_ends(data, block)
        while block > LEAST_BLOCK and len(found) < SIGNATURE // 2:
            block //= 2
            found, double = _long_ends(data, block)
        return f"{block}:{_long_signature(data, found)}:{_long_signature(data, double)}"
    rolling = _rolling(data)
    up, down = _POWERS.upto(size)
    sums = np.cumsum(_table()[data] * up)

    def ends(b: int) -> np.ndarray:
        return np.flatnonzero(rolling % U64(b) == U64(b - 1)) + 1

    found = ends(block)
    double = ends(2 * block)
    while block > LEAST_BLOCK and len(found) < SIGNATURE // 2:
        block //= 2
        found, double = ends(block), found
    return f"{block}:{_signature(found, sums, down, size)}:{_signature(double, sums, down, size)}"


def likeness(left: str, right: str) -> Column:
    """How alike two fingerprints are, 0 to 1: edit distance of signatures at compatible block sizes.

    Block sizes are compatible if equal or one is twice the other; of the pairs of
    signatures at one block size the best counts. Signatures without a common run
    of 7 characters (or of the shorter one's length) are unlike. Equal
    fingerprints are 1, a null one gives null.
    """

    def part(c: str, i: int) -> Column:
        return F.element_at(F.split(F.col(c), ":"), i)

    def alike(a: Column, b: Column) -> Column:
        run = F.least(F.lit(SHARED_RUN), F.length(a), F.length(b))
        common = F.exists(
            F.sequence(F.lit(1), F.length(a) - run + 1), lambda i: F.instr(b, F.substring(a, i, run)) > 0)
        longest = F.greatest(F.length(a), F.length(b))
        return F.when((F.length(a) > 0) & (F.length(b) > 0) & common, 1 - F.levenshtein(a, b) / longest).otherwise(0.0)

    a_block, b_block = part(left, 1).cast("long"), part(right, 1).cast("long")
    same = F.greatest(alike(part(left, 2), part(right, 2)), alike(part(left, 3), part(right, 3)))
    best = (
        F.when(a_block == b_block, same)
        .when(a_block == b_block * 2, alike(part(left, 2), part(right, 3)))
        .when(a_block * 2 == b_block, alike(part(left, 3), part(right, 2)))
        .otherwise(0.0)
    )
    return F.when(F.col(left) == F.col(right), 1.0).when(F.col(left).isNull() | F.col(right).isNull(), None).otherwise(best).cast("double")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the next one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_ROW = "part int, kind string, doc_id long, text string, fingerprint string, n_chars long, edited_sha256 string, edited_fingerprint string, next_fingerprint string"


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task in order: each with its next one. The task's first and last rows come out as well, to meet other tasks'."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    waiting: tuple | None = None
    out: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = [c.split()[0] for c in _ROW.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in slices(batches, "text"):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True):
            mark = fingerprint(text)
            if waiting is None:
                out.append((part, "first", doc_id, text, mark, None, None, None, None))
            else:
                out.append((part, "done", *_finished(*waiting, text, mark)))
            waiting = (doc_id, text, mark)
        if out:
            yield batch_of(out)
            out = []
    if waiting is not None:
        yield batch_of([(part, "last", *waiting, None, None, None, None)])


def _finished(doc_id: int | None, text: str, mark: str, following: str, following_mark: str) -> tuple:
    other = edited(text, following)
    return doc_id, None, mark, len(text), hashlib.sha256(other.encode()).hexdigest(), mark if other == text else fingerprint(other), following_mark


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            done = _finished(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_fingerprint"])
            rows.append((done[0], *done[2:]))
        if rows:
            names = ["doc_id", "fingerprint", "n_chars", "edited_sha256", "edited_fingerprint", "next_fingerprint"]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole ``text`` (null counts as empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            marks = [fingerprint(t) for t in strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document.

    The next document is the next row by ``doc_id`` (nulls first; equal ids by
    text hash), after the last the first; a single row is its own next. Null text
    counts as empty; repeated rows each have a row; other columns are ignored; an
    empty table gives no rows.

    The texts are dealt by ranges of ``doc_id`` and walked in order, one shuffle
    in all. What a range lacks is the first text of the next filled range: those
    rows, one per task, meet in a join on the range's number.
    """
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    texts = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).withColumn("_tie", F.xxhash64("text"))
    dealt = texts.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "_tie")
    rows = store(dealt.select("doc_id", "text").mapInArrow(_in_order, _ROW), "ordered")

    edges = rows.where("kind <> 'done'")
    filled = [r["part"] for r in edges.where("kind = 'last'").select("part").distinct().orderBy("part").collect()]  # one per task
    after = list(zip(filled, filled[1:] + filled[:1], strict=True))
    following = spark.createDataFrame(after, "part int, next_part int")
    first = edges.where("kind = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    last = edges.where("kind = 'last'").select("part", "doc_id", "text", "fingerprint")
    ends = last.join(following, "part").join(first, "next_part").select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    closed = ends.mapInArrow(
        _joined, "doc_id long, fingerprint string, n_chars long, edited_sha256 string, edited_fingerprint string, next_fingerprint string")
    done = rows.where("kind = 'done'").select(closed.columns)
    return done.unionByName(closed).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
