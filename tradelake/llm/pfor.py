"""Patched frame-of-reference blocks for unsigned 32-bit ids.

A buffer: magic, number of ids (u64), block size (u32), then for each block its minimum (u32),
bit width (u8), number of exceptions (u8) and the place of its data (u32), then the data: the
low bits of ``id - minimum`` packed at the width, the positions of the exceptions (u8) and
their high bits (u32). The width covers a chosen percentile of a block, so that one rare large
id does not widen the others. The block starts are the index by which ``block`` reads one block.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"PFB1"
BLOCK = 128
_HEAD = struct.Struct("<4sQI")


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(g, 128) values below 2**width as (g, 16 * width) bytes: two runs of 64 lanes."""
    g = len(values)
    if not width:
        return np.zeros((g, 0), dtype=np.uint8)
    lanes = np.ascontiguousarray(values.reshape(2 * g, 64).T).astype(np.uint64)
    words = np.zeros((width, 2 * g), dtype=np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[word] |= lanes[j] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).view(np.uint8).reshape(g, 16 * width)


def _unpack(data: np.ndarray, width: int) -> np.ndarray:
    g = len(data)
    if not width:
        return np.zeros((g, BLOCK), dtype=np.uint32)
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").reshape(2 * g, width).T)
    lanes = np.empty((64, 2 * g), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        x = words[word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[word + 1] << np.uint64(64 - shift))
        lanes[j] = x & mask
    return np.ascontiguousarray(lanes.T).reshape(g, BLOCK)


def encode(ids: np.ndarray, percentile: float = 0.9) -> bytes:
    n = len(ids)
    nb = -(-n // BLOCK)
    if not nb:
        return _HEAD.pack(MAGIC, 0, BLOCK)
    values = np.concatenate([ids, np.full(nb * BLOCK - n, ids[-1])]).astype(np.uint32).reshape(nb, BLOCK)
    mins = values.min(axis=1)
    above = values - mins[:, None]
    cover = np.partition(above, k := max(0, int(np.ceil(percentile * BLOCK)) - 1), axis=1)[:, k]
    widths = np.ceil(np.log2(cover.astype(np.float64) + 1)).astype(np.int64)
    high = above.astype(np.uint64) >> widths.astype(np.uint64)[:, None]
    rows, cols = np.nonzero(high)
    exceptions = np.bincount(rows, minlength=nb)
    sizes = 16 * widths + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), dtype=np.uint8)
    low = above & ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    for w in np.unique(widths[widths > 0]):
        group = np.nonzero(widths == w)[0]
        data[starts[group][:, None] + np.arange(16 * w)] = _pack(low[group], int(w))
    if len(rows):
        rank = np.arange(len(rows)) - (np.cumsum(exceptions) - exceptions)[rows]
        base = (starts + 16 * widths)[rows]
        data[base + rank] = cols
        at = base + exceptions[rows] + 4 * rank
        data[at[:, None] + np.arange(4)] = high[rows, cols].astype("<u4").view(np.uint8).reshape(-1, 4)
    return b"".join(
        [
            _HEAD.pack(MAGIC, n, BLOCK),
            mins.astype("<u4").tobytes(),
            widths.astype(np.uint8).tobytes(),
            exceptions.astype(np.uint8).tobytes(),
            starts.astype("<u4").tobytes(),
            data.tobytes(),
        ]
    )


def _parts(buffer: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    magic, n, size = _HEAD.unpack_from(buffer)
    if magic != MAGIC or size != BLOCK:
        raise ValueError("not a block buffer")
    nb = -(-n // BLOCK)
    at = _HEAD.size
    mins = np.frombuffer(buffer, "<u4", nb, at)
    widths = np.frombuffer(buffer, np.uint8, nb, at + 4 * nb).astype(np.int64)
    exceptions = np.frombuffer(buffer, np.uint8, nb, at + 5 * nb).astype(np.int64)
    starts = np.frombuffer(buffer, "<u4", nb, at + 6 * nb).astype(np.int64)
    return n, mins, widths, exceptions, starts, np.frombuffer(buffer, np.uint8, -1, at + 10 * nb)


def _blocks(mins, widths, exceptions, starts, data) -> np.ndarray:
    nb = len(mins)
    values = np.zeros((nb, BLOCK), dtype=np.uint32)
    for w in np.unique(widths[widths > 0]):
        group = np.nonzero(widths == w)[0]
        values[group] = _unpack(data[starts[group][:, None] + np.arange(16 * w)], int(w))
    rows = np.repeat(np.arange(nb), exceptions)
    if len(rows):
        rank = np.arange(len(rows)) - (np.cumsum(exceptions) - exceptions)[rows]
        base = (starts + 16 * widths)[rows]
        cols = data[base + rank]
        at = base + exceptions[rows] + 4 * rank
        high = np.ascontiguousarray(data[at[:, None] + np.arange(4)]).view("<u4").ravel().astype(np.uint64)
        values[rows, cols] |= (high << widths[rows].astype(np.uint64)).astype(np.uint32)
    return values + mins[:, None]


def decode(buffer: bytes) -> np.ndarray:
    n, *parts = _parts(buffer)
    return _blocks(*parts).ravel()[:n]


def block(buffer: bytes, k: int) -> np.ndarray:
    """The ids of block ``k`` alone, by its start."""
    n, mins, widths, exceptions, starts, data = _parts(buffer)
    one = slice(k, k + 1)
    return _blocks(mins[one], widths[one], exceptions[one], starts[one], data).ravel()[: n - k * BLOCK]
