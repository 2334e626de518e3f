"""Reading byte ranges of files inside tasks."""

import math
import sys

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle

# Ship the reader with the job, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Frames handed to Spark at a time.
BATCH_FRAMES = 64


def open_path(path: str):
    """Random-access file behind a Spark path (file:, hdfs:, s3:, ...)."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path[len("file:"):].lstrip("/"))
    system, inner = pafs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def slice_reader(size: int):
    """``mapInArrow`` function: (path, first, n) ranges to (path, frame_seq, data)."""

    def read(batches):
        for ranges in batches:
            for path, first, n in zip(*(column.to_pylist() for column in ranges.columns)):
                with open_path(path) as source:
                    source.seek(first * size)
                    for start in range(first, first + n, BATCH_FRAMES):
                        stop = min(start + BATCH_FRAMES, first + n)
                        frames = [source.read(size) for _ in range(start, stop)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(frames)), pa.array(range(start, stop), type=pa.int64()),
                             pa.array(frames, type=pa.binary())],
                            names=["path", "frame_seq", "data"],
                        )

    return read


def outcome_reader(size: int, ratio: float | None = None):
    """``mapInArrow`` function: (path, first, n, rest) ranges to (path, frame_seq, data, error).

    ``rest`` bytes after the last frame of a range are a row without data. With
    ``ratio`` (wanted frames per frame of the file) only the first frame of every
    wanted one is read.
    """

    def wanted(number: int) -> bool:
        return ratio is None or number == 0 or math.floor(number * ratio) != math.floor((number - 1) * ratio)

    def read(batches):
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.string()]
        names = ["path", "frame_seq", "data", "error"]

        def pack(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for ranges in batches:
            for path, first, n, rest in zip(*(column.to_pylist() for column in ranges.columns)):
                rows = []
                with open_path(path) as source:
                    for number in filter(wanted, range(first, first + n)):
                        source.seek(number * size)
                        data = source.read(size)
                        if len(data) < size:  # shorter than when it was listed: Spark tries the task again
                            raise OSError(f"{path} ends within frame {number}")
                        rows.append((path, number, data, None))
                        if len(rows) == BATCH_FRAMES:
                            yield pack(rows)
                            rows = []
                if rest:
                    rows.append((path, first + n, None, f"partial frame of {rest} bytes"))
                if rows:
                    yield pack(rows)

    return read
