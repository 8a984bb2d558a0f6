"""Rolling hashes in numpy: of words, of windows of words, of windows of bytes. All arithmetic is modulo 2**64."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Texts are hashed so many bytes at a time.
SEGMENT = 1 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


class Stream:
    """One family of hashes: a random value per byte and an odd base."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(rng.integers(0, 1 << 60)) * 8 + 5
        self._up = self._down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``base**i`` and its inverse for i < n."""
        if n > len(self._up):
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                self._up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, self.base & MASK, np.uint64)])
                inverse = pow(self.base, -1, 1 << 64)
                self._down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, inverse, np.uint64)])
        return self._up[:n], self._down[:n]


MASK = (1 << 64) - 1


@lru_cache(maxsize=8)
def stream(seed: int) -> Stream:
    return Stream(seed)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without NULL; the offsets start at 0."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with at most ``most`` bytes together, or one text that has more."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the text it is in; a word ends with its text."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    ink = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(ink & (np.r_[True, ~ink[:-1]] | edge[:-1]))
    ends = np.flatnonzero(ink & (np.r_[~ink[1:], True] | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    out, at, family = np.zeros(len(starts), np.uint64), 0, stream(seed)
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + SEGMENT, "right")))
        low, part = starts[at], data[starts[at] : ends[end - 1]]
        up, down = family.powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(family.table[part] * up[:-1], out=sums[1:])
        s, e = starts[at:end] - low, ends[at:end] - low
        raw = (sums[e] - sums[s]) * down[s]
        out[at:end] = mix(raw + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = end
    return out


def window_hashes(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Of every ``size`` consecutive values, for each start but the last ``size - 1``."""
    n, family = len(hashes), stream(seed)
    if n < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(n - size + 1, np.uint64)
    for at in range(0, n - size + 1, SEGMENT):
        part = hashes[at : at + SEGMENT + size - 1]
        up, down = family.powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:-1], out=sums[1:])
        m = len(part) - size + 1
        out[at : at + m] = mix((sums[size:] - sums[:m]) * down[:m])
    return out


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values: running minima from both ends of blocks of that size."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, size)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[size - 1 : size - 1 + n])


def runs(starts_new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run, from a mask of where runs start."""
    first = np.flatnonzero(starts_new)
    return first, np.diff(np.r_[first, len(starts_new)])
