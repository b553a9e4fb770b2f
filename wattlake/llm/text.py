"""Words of whole Arrow text columns, found and hashed with numpy in the bytes of a batch.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``.  Those bytes never occur inside a
UTF-8 sequence, so bytes and characters give the same words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    where = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[where[0] : where[-1]], where - where[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes kept."""
    to = np.arange(256, dtype=np.uint8)
    to[65:91] += 32
    return to[data]


def spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each word, its end, index of the first word of each text, with one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~spaces(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Hasher:
    """64-bit hashes of byte ranges: a polynomial over random values of the bytes, modulo 2^64, then mixed.

    Prefix sums give all ranges of a segment at once.  Two given different words collide with a
    probability near 2^-63.  One object per task; ``seed`` fixes the values, so all tasks agree.
    """

    SPAN = 1 << 17

    def __init__(self, seed: int = 20) -> None:
        self.values = np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
        factor = (int(self.values[0]) & ~7) | 3
        self.factor, self.inverse = factor, pow(factor, -1, 1 << 64)
        self.size = 0

    def _grow(self, size: int) -> None:
        if size > self.size:
            power = np.ones(size + 1, np.uint64)
            back = np.ones(size + 1, np.uint64)
            power[1:], back[1:] = np.uint64(self.factor), np.uint64(self.inverse)
            self.power, self.back, self.size = np.cumprod(power), np.cumprod(back), size

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``data[starts:ends]``; the ranges are ascending and don't overlap."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            low = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, low + self.SPAN, "right")))
            part = data[low : ends[to - 1]]
            self._grow(max(len(part), min(self.SPAN, len(data))))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.values[part] * self.power[: len(part)], out=sums[1:])
            s, e = starts[at:to] - low, ends[at:to] - low
            out[at:to] = mix((sums[e] - sums[s]) * self.back[s] + (e - s).astype(np.uint64))
            at = to
        return out


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of ``n`` words, index of each text's first run with one more at the end).

    A text with 1 to n-1 words has one run, the whole sequence; one without words has none.
    """
    count = np.diff(first)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    where = np.concatenate([[0], np.cumsum(runs)])
    total = int(where[-1])
    if not total:
        return np.zeros(0, np.uint64), where
    at = np.arange(total) - np.repeat(where[:-1], runs) + np.repeat(first[:-1], runs)
    length = np.repeat(np.minimum(count, n), runs)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    out = np.zeros(total, np.uint64)
    for k in range(n):
        out = np.where(k < length, mix(out * np.uint64(0x9E3779B97F4A7C15) + padded[at + k]), out)
    return mix(out + length.astype(np.uint64)), where


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20):
    """Row ranges of a batch whose texts have about ``most`` bytes, one text at least."""
    offsets = buffers(batch.column(column))[1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
