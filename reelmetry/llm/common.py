"""Shared pieces: word hashes over byte blocks, Arrow batches of texts, task-local keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

U64 = np.uint64
#: Bytes hashed at a time; longer texts go through in pieces that end at a separator.
BLOCK = 1 << 20

#: White space of the word rule: space and 0x09 to 0x0D.
WHITE_SPACE = np.zeros(256, dtype=bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (two multiply-xorshift rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


@lru_cache(maxsize=4)
def constants(count: int, salt: int) -> np.ndarray:
    """``count`` fixed odd 64-bit numbers."""
    base = np.arange(1, count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt)
    return mix(base) | U64(1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, and the powers of a multiplier and of its inverse modulo 2**64."""
    p = 0x5851F42D4C957F2D
    up = np.full(BLOCK + 1, p, dtype=U64)
    down = np.full(BLOCK + 1, pow(p, -1, 1 << 64), dtype=U64)
    up[0] = down[0] = 1
    return constants(256, 77), np.cumprod(up), np.cumprod(down)


def _hash_block(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a block that ends with a separator."""
    table, up, down = _powers()
    capital = (data >= 65) & (data <= 90)
    data = data + capital.astype(np.uint8) * np.uint8(32)
    apart = separators[data]
    edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
    if not apart[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    sums = np.cumsum(table[data] * up[: len(data)])
    before = np.where(starts > 0, sums[starts - 1], U64(0))
    return starts, mix((sums[ends - 1] - before) * down[starts] + (ends - starts).astype(U64))


def _hash_giant(word: bytes) -> np.uint64:
    """A word longer than a block, folded block by block."""
    table, up, _ = _powers()
    total = np.array([len(word)], dtype=U64)
    for at in range(0, len(word), BLOCK):
        part = np.frombuffer(word[at : at + BLOCK], dtype=np.uint8)
        part = part + ((part >= 65) & (part <= 90)).astype(np.uint8) * np.uint8(32)
        total = mix(total + np.sum(table[part] * up[: len(part)], dtype=U64))
    return total[0]


def _pieces(text: bytes, separators: np.ndarray) -> Iterator[bytes]:
    """A long text in blocks that end between words; a giant word is a piece of its own."""
    at = 0
    while len(text) - at >= BLOCK:
        cuts = np.flatnonzero(separators[np.frombuffer(text, dtype=np.uint8, count=BLOCK, offset=at)])
        if len(cuts):
            end = at + int(cuts[-1]) + 1
        else:
            end = at + BLOCK
            while end < len(text):
                step = separators[np.frombuffer(text, dtype=np.uint8, count=min(BLOCK, len(text) - end), offset=end)]
                if step.any():
                    end += int(step.argmax())
                    break
                end += len(step)
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: Sequence[bytes], separators: np.ndarray = WHITE_SPACE) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words, A-Z lower-cased, in order.

    Words are runs of bytes that are no separators. Equal words have equal hashes
    wherever they stand; short texts share a block, long ones go in pieces.
    """
    group: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        if not group:
            return
        first = np.cumsum([0, *(len(t) + 1 for t in group)])
        starts, hashes = _hash_block(np.frombuffer(b" ".join(group) + b" ", dtype=np.uint8), separators)
        cut = np.searchsorted(starts, first)
        for i in range(len(group)):
            yield hashes[cut[i] : cut[i + 1]]

    for text in texts:
        if size + len(text) + 1 > BLOCK and group:
            yield from flush()
            group, size = [], 0
        if len(text) + 1 > BLOCK:
            parts = []
            for piece in _pieces(text, separators):
                if len(piece) >= BLOCK:
                    parts.append(np.array([_hash_giant(piece)], dtype=U64))
                elif piece:
                    parts.append(_hash_block(np.frombuffer(piece + b" ", dtype=np.uint8), separators)[1])
            yield np.concatenate(parts) if parts else np.empty(0, dtype=U64)
            continue
        group.append(text)
        size += len(text) + 1
    yield from flush()


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """Texts as strings; null counts as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each have about ``most`` bytes; a longer text stands alone."""
    for batch in batches:
        sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(text)).to_pylist()], dtype=np.int64)
        start = total = 0
        for i, n in enumerate(sizes):
            if total + n > most and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(sizes) > start:
            yield batch.slice(start)


def give_back() -> None:
    """Returns freed memory to the system at a task's end.

    Arrow's pool and the C library keep it otherwise, and a worker stays for a minute
    after its last task, beside what the executor does next.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def task_keys() -> Callable[[int], np.ndarray]:
    """A source of 64-bit row keys, unique over all tasks of a stage; use it where the rows are stored."""
    context = TaskContext.get()
    state = [(context.partitionId() if context else 0) << 36]

    def take(count: int) -> np.ndarray:
        keys = np.arange(state[0], state[0] + count, dtype=np.int64)
        state[0] += count
        return keys

    return take
