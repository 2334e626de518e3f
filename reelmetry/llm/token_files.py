"""Token ids of documents in binary files of patched frame-of-reference blocks, and reading them back.

A file is a run of frames. A frame is a head (fixed values below), then four codes
of ``pfor``: the documents' ids, which of them are null, their counts of token ids
in this frame, and the token ids. Every code has an index of its blocks, so some
ids of a frame can be read without the rest. A line end follows every frame.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelmetry.llm import pfor
from reelmetry.llm.common import slices, strings
from reelmetry.llm.token_ids import word_ids
from reelmetry.operators.skew import store
from reelmetry.session import scratch_path

# Fixed values of the format: mark, frame's bytes, file range, number of the first document in the range, token ids
# before the frame in the range, token ids in the frame, whether its first document began before and its last one goes on.
MARK, END = b"TIDS", b"\n"
_HEAD = struct.Struct("<4sQIQQQBB")
#: Token ids per frame, and frames per file: a file has at most 16.8 million ids, some 34 MB of them.
FRAME_IDS, FILE_FRAMES = 1 << 18, 64


def frame(part: int, first: int, before: int, ids: bytes, dtype: np.dtype, doc_ids: list[int | None], counts: list[int], begun: bool, goes_on: bool) -> bytes:
    """One frame of whole or cut documents."""
    values = np.frombuffer(ids, dtype=dtype)
    body = b"".join((
        pfor.encode(np.array([0 if d is None else d for d in doc_ids], dtype=np.int64)), pfor.encode(np.array([d is None for d in doc_ids], dtype=np.int64)),
        pfor.encode(np.array(counts, dtype=np.int64)), pfor.encode(values.astype(np.int64)),
    ))
    return _HEAD.pack(MARK, _HEAD.size + len(body), part, first, before, len(values), begun, goes_on) + body


class Frame:
    """A frame that is read: its head, and its codes when asked for."""

    def __init__(self, data: bytes | memoryview, at: int = 0) -> None:
        mark, self.size, self.part, self.first, self.before, self.count, begun, goes_on = _HEAD.unpack_from(data, at)
        if mark != MARK:
            raise ValueError(f"no frame at byte {at}")
        self.begun, self.goes_on = bool(begun), bool(goes_on)
        self._data = data
        self._codes = [at + _HEAD.size]
        for _ in range(3):
            self._codes.append(self._codes[-1] + pfor.encoded_size(data, self._codes[-1]))

    def doc_ids(self) -> list[int | None]:
        null = pfor.decode(self._data, self._codes[1]).tolist()
        return [None if n else d for d, n in zip(pfor.decode(self._data, self._codes[0]).tolist(), null, strict=True)]

    def counts(self) -> np.ndarray:
        return pfor.decode(self._data, self._codes[2])

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Token ids ``start`` to ``stop`` of the frame, from the blocks that hold them."""
        return pfor.decode(self._data, self._codes[3], start, stop)


def frames(data: bytes | memoryview) -> Iterator[Frame]:
    """The frames of a file; raises if the file isn't whole."""
    at = 0
    while at < len(data):
        found = Frame(data, at)
        at += found.size
        if bytes(data[at : at + len(END)]) != END:
            raise ValueError(f"no end of frame at byte {at}")
        yield found
        at += len(END)


def crc_joined(first: int, second: int, size: int) -> int:
    """The crc32 of two byte strings one after the other, from theirs and the second one's length."""

    def times(a: int, b: int) -> int:  # product of polynomials, highest power in the lowest bit, modulo the crc's
        out = 0
        for bit in range(31, -1, -1):
            if a >> bit & 1:
                out ^= b
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        return out

    power, square = 1 << 31, 1 << 23  # 1 and x**8
    while size:
        if size & 1:
            power = times(power, square)
        square, size = times(square, square), size >> 1
    return times(power, first) ^ second


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1) -> None:
    """Writes the token ids of all documents, each followed by ``end_id``, in ascending ``doc_id`` order.

    The texts are dealt by ranges of ``doc_id`` (nulls first; equal ids by text
    hash, equal rows by where they are read, so that copies spread over ranges),
    sorted and encoded in one pass. Spark's text sink writes the frames as they
    are and commits whole tasks, so a lost executor or a second attempt leaves
    nothing behind. Null and empty texts are ``end_id`` alone; a text longer than a
    frame goes on in the next ones; repeated rows are written each; other columns
    are ignored; an empty table gives a folder without frames.
    """
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    texts = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    keyed = texts.withColumns({"_tie": F.xxhash64("text"), "_copy": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(n, "doc_id", "_tie", "_copy").sortWithinPartitions("doc_id", "_tie", "_copy").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = word_ids(tokenizer)
        wide, part = coder.dtype.itemsize, TaskContext.get().partitionId()
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        first = before = 0
        ids, doc_ids, counts, begun = bytearray(), [], [], False

        def full(goes_on: bool) -> pa.RecordBatch:
            nonlocal first, before, ids, doc_ids, counts, begun
            made = frame(part, first, before, bytes(ids), coder.dtype, doc_ids, counts, begun, goes_on)
            first, before = first + len(doc_ids) - goes_on, before + len(ids) // wide
            ids, doc_ids, counts, begun = bytearray(), [], [], goes_on
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["value"])

        for batch in slices(batches, "text"):
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), coder.encode_many(strings(batch.column("text"))), strict=True):
                rest = memoryview(found + end)
                while len(rest):
                    own = rest[: FRAME_IDS * wide - len(ids)]
                    rest = rest[len(own) :]
                    ids += own
                    doc_ids.append(doc_id)
                    counts.append(len(own) // wide)
                    if len(ids) == FRAME_IDS * wide:
                        yield full(bool(len(rest)))
        if doc_ids:
            yield full(False)

    made = dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    made.write.option("lineSep", END.decode()).option("maxRecordsPerFile", FILE_FRAMES).option("compression", "none").text(folder)


_PIECE = "part int, document long, local_start long, doc_id long, n_tokens long, ids_crc32 long, whole boolean"


def _pieces(spark: SparkSession, folder: str, with_ids: bool) -> DataFrame:
    """What every file holds of each document; cut documents have several pieces."""
    schema = _PIECE + ", ids binary" * with_ids
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.bool_()] + [pa.binary()] * with_ids
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = memoryview(content.as_buffer())
                rows: list[list] = []
                open_row: list | None = None
                for f in frames(data):
                    ids = f.ids().astype("<u4")
                    raw, at = memoryview(ids).cast("B"), 0
                    doc_ids, counts = f.doc_ids(), f.counts().tolist()
                    for k, (doc_id, count) in enumerate(zip(doc_ids, counts, strict=True)):
                        own = raw[4 * at : 4 * (at + count)]
                        if k or not f.begun or open_row is None:  # a document begun in an earlier file is a piece of its own
                            open_row = [f.part, f.first + k, f.before + at, doc_id, 0, 0, not (f.begun and not k)] + [[]] * with_ids
                        open_row[4] += count
                        open_row[5] = zlib.crc32(own, open_row[5])
                        if with_ids:
                            open_row[7] = [*open_row[7], bytes(own)]
                        at += count
                        if k < len(counts) - 1 or not f.goes_on:
                            rows.append(open_row)
                            open_row = None
                    if with_ids:
                        for r in rows:
                            r[7] = r[7] if isinstance(r[7], bytes) else b"".join(r[7])
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if open_row is not None:
                    open_row[6] = False
                    if with_ids:
                        open_row[7] = b"".join(open_row[7])
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(open_row, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(run, schema)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, and ``ids`` if asked.

    ``start`` counts the ids of all documents before, ``ids_crc32`` is of the ids as
    little-endian unsigned 32-bit integers, and so are ``ids``. Files are read apart
    from each other, a file (at most FILE_FRAMES frames) a row. The ids before a
    range are summed over one row per range. A document that goes on in another
    file is put together from its pieces, one per file. A folder without frames
    gives no rows; a damaged file fails the job.
    """
    pieces = store(_pieces(spark, folder, with_ids), "pieces")
    totals = pieces.groupBy("part").agg(F.sum("n_tokens").alias("ids"))  # one row per task of the write
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select("part", before.alias("base"))

    joined = F.udf(lambda crcs, sizes: _all_joined(crcs, sizes), "long")
    cut = pieces.where("NOT whole").groupBy("part", "document").agg(
        F.array_sort(F.collect_list(F.struct("local_start", "n_tokens", "ids_crc32", *["ids"] * with_ids))).alias("of"), F.first("doc_id").alias("doc_id"))
    restored = cut.select(
        "part", "doc_id", F.col("of")[0]["local_start"].alias("local_start"),
        F.aggregate("of.n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n_tokens"),
        joined("of.ids_crc32", "of.n_tokens").alias("ids_crc32"),
        *[F.aggregate("of.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids")] * with_ids,
    )
    rows = pieces.where("whole").select(restored.columns).unionByName(restored)
    start = (F.col("base") + F.col("local_start")).alias("start")
    return rows.join(bases, "part").select("doc_id", start, "n_tokens", "ids_crc32", *["ids"] * with_ids)


def _all_joined(crcs: list[int], sizes: list[int]) -> int:
    out = crcs[0]
    for crc, size in zip(crcs[1:], sizes[1:], strict=True):
        out = crc_joined(out, crc, 4 * size)
    return out


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Writes the token ids of ``docs`` to the shared scratch folder and returns what ``read_ids`` finds there."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_ids(docs, folder, tokenizer, end_id)
    return read_ids(docs.sparkSession, folder)
