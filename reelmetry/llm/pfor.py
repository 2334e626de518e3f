"""Patched frame-of-reference coding of integers: blocks with a minimum, packed small differences and exceptions."""

from __future__ import annotations

import struct

import numpy as np

U64 = np.uint64
#: Values per block, and the share of them that the packed width must hold.
BLOCK, PERCENTILE = 128, 90

#: count of values, count of blocks; then one start per block and the end, relative to the first block.
_HEAD = struct.Struct("<QI")
#: minimum, width, count of exceptions, bytes per exception.
_BLOCK_HEAD = 8 + 1 + 1 + 1


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits needed by each unsigned value."""
    out = np.zeros(values.shape, dtype=np.int64)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        large = rest >= U64(1 << step)
        out[large] += step
        rest[large] >>= U64(step)
    return out + (rest > 0)


def _packed(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width, as bytes: value i takes the bits from i * width on, lowest first."""
    values = np.ascontiguousarray(rows.T)
    words = np.zeros((BLOCK * width // 64, len(rows)), dtype=U64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        words[word] |= values[i] << U64(shift)
        if shift + width > 64:
            words[word + 1] |= values[i] >> U64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).view(np.uint8).reshape(len(rows), BLOCK * width // 8)


def _unpacked(data: np.ndarray, width: int) -> np.ndarray:
    """What ``_packed`` packed."""
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").astype(U64, copy=False).T)
    out = np.empty((BLOCK, words.shape[1]), dtype=U64)
    mask = U64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        np.right_shift(words[word], U64(shift), out=out[i])
        if shift + width > 64:
            out[i] |= words[word + 1] << U64(64 - shift)
    out &= mask
    return out.T


def encode(values: np.ndarray) -> bytes:
    """Signed 64-bit values, coded block by block, behind an index of block starts.

    A block holds its minimum, the differences to it in a fixed width that is
    enough for PERCENTILE of 100 of them, and for the others their place and what
    lies above that width. The last block is filled up with its minimum.
    """
    values = np.ascontiguousarray(values, dtype=np.int64)
    count = len(values)
    blocks = -(-count // BLOCK)
    if not count:
        return _HEAD.pack(0, 0) + struct.pack("<I", 0)
    rows = np.empty((blocks, BLOCK), dtype=np.int64)
    rows.reshape(-1)[:count] = values
    rows.reshape(-1)[count:] = values[(blocks - 1) * BLOCK :].min()
    least = rows.min(axis=1)
    # Differences of any two signed values fit in 64 unsigned bits.
    above = rows.view(U64) - least.view(U64)[:, None]
    most = above.max(axis=1)
    keep = -(-BLOCK * PERCENTILE // 100) - 1
    narrow = above.astype(np.uint16 if most.max() < 1 << 16 else U64, copy=False)
    widths = _bit_lengths(np.partition(narrow, keep, axis=1)[:, keep].astype(U64))
    limits = (U64(1) << np.minimum(widths, 63).astype(U64)) - U64(1)
    limits[widths == 64] = ~U64(0)
    over = above > limits[:, None]
    exceptions = over.sum(axis=1)
    wide = np.where(exceptions > 0, -(-(_bit_lengths(most) - widths) // 8), 0)

    sizes = _BLOCK_HEAD + BLOCK * widths // 8 + exceptions * (1 + wide)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), dtype=np.uint8)
    at = starts[:-1]
    out[at[:, None] + np.arange(8)] = least.astype("<i8").view(np.uint8).reshape(blocks, 8)
    out[at + 8], out[at + 9], out[at + 10] = widths, exceptions, wide
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        if width:
            packed = _packed(above[own] & U64((1 << width) - 1), width)
            out[(at[own] + _BLOCK_HEAD)[:, None] + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(over)
    if len(row):
        first = np.cumsum(exceptions) - exceptions
        nth = np.arange(len(row)) - first[row]
        places_at = at[row] + _BLOCK_HEAD + BLOCK * widths[row] // 8
        out[places_at + nth] = place
        rest = (above[row, place] >> widths[row].astype(U64)).astype("<u8").view(np.uint8).reshape(len(row), 8)
        for k in range(int(wide.max())):
            has = wide[row] > k
            out[(places_at + exceptions[row] + nth * wide[row] + k)[has]] = rest[has, k]
    return _HEAD.pack(count, blocks) + starts.astype("<u4").tobytes() + out.tobytes()


def encoded_size(data: bytes | memoryview, at: int = 0) -> int:
    """Bytes of the code that begins at ``at``."""
    _, blocks = _HEAD.unpack_from(data, at)
    index = at + _HEAD.size
    return _HEAD.size + 4 * (blocks + 1) + struct.unpack_from("<I", data, index + 4 * blocks)[0]


def decode(data: bytes | memoryview, at: int = 0, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Values ``start`` to ``stop`` of the code that begins at ``at``; only the blocks that hold them are read."""
    count, blocks = _HEAD.unpack_from(data, at)
    stop = count if stop is None else min(stop, count)
    start = max(start, 0)
    if start >= stop:
        return np.empty(0, dtype=np.int64)
    first, last = start // BLOCK, (stop - 1) // BLOCK + 1
    index = np.frombuffer(data, dtype="<u4", count=last - first + 1, offset=at + _HEAD.size + 4 * first).astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8, count=int(index[-1] - index[0]), offset=at + _HEAD.size + 4 * (blocks + 1) + int(index[0]))
    begin = (index - index[0])[:-1]
    least = body[begin[:, None] + np.arange(8)].copy().view("<i8").reshape(-1).astype(np.int64)
    widths, exceptions, wide = (body[begin + k].astype(np.int64) for k in (8, 9, 10))
    above = np.zeros((last - first, BLOCK), dtype=U64)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        if width:
            above[own] = _unpacked(body[(begin[own] + _BLOCK_HEAD)[:, None] + np.arange(BLOCK * width // 8)], width)
    row = np.repeat(np.arange(last - first), exceptions)
    if len(row):
        nth = np.arange(len(row)) - (np.cumsum(exceptions) - exceptions)[row]
        places_at = begin[row] + _BLOCK_HEAD + BLOCK * widths[row] // 8
        rest = np.zeros(len(row), dtype=U64)
        for k in range(int(wide.max())):
            has = wide[row] > k
            rest[has] |= body[(places_at + exceptions[row] + nth * wide[row] + k)[has]].astype(U64) << U64(8 * k)
        above[row, body[places_at + nth]] |= rest << widths[row].astype(U64)
    values = (above + least.view(U64)[:, None]).view(np.int64).reshape(-1)
    return values[start - first * BLOCK : stop - first * BLOCK]
