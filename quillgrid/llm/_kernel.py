"""Vectorised text kernels over Arrow string columns.

A text column is one byte buffer with offsets. Words, their hashes and the
hashes of runs of words are found for a whole slice of rows by numpy, without a
Python step for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Seeds of the two hashes of a word, and bases of the two hashes of a run of words.
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BASES = (0x0F7A3C95B2D1E86B, 0x1B58D2C3A94E7F05)
#: Words longer than this are hashed one by one.
LONG_WORD = 256
#: The modulus of run hashes, 2 ** 61 - 1.
PRIME = (1 << 61) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def eights(data: np.ndarray, beyond: int = 8) -> np.ndarray:
    """A view of the eight bytes from each position on as one number, zeros after the end; beyond: positions after it."""
    padded = np.zeros(len(data) + beyond + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + beyond, dtype="<u8", buffer=padded, strides=(1,))


def run_hashes(c: np.ndarray, at: np.ndarray | slice, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the length bytes (8 or more) from each position at, of c = eights(data): one chain of mixed numbers."""
    h = None
    for k in [*range(0, length - 8, 8), length - 8]:
        x = c[slice(at.start + k, at.stop + k) if isinstance(at, slice) else at + k]
        h = (x ^ _U(seed + length)) if h is None else h ^ x
        h = h * _U(0x9FB21C651E98DF25)
        h ^= h >> _U(29)
    return mix(h)


def times(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo PRIME; both below it."""
    low, high = a & _U((1 << 31) - 1), a >> _U(31)
    b0, b1 = _U(b & ((1 << 31) - 1)), _U(b >> 31)
    middle = high * b0 + low * b1
    out = _U(2) * (high * b1) + (middle >> _U(30)) + ((middle & _U((1 << 30) - 1)) << _U(31)) + low * b0
    return _folded(out)


def _folded(x: np.ndarray) -> np.ndarray:
    x = (x & _U(PRIME)) + (x >> _U(61))
    return np.where(x >= _U(PRIME), x - _U(PRIME), x)


def rabin_karp(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash modulo PRIME of each run of width values, by doubling: no power tables, no inverse.

    A run of n is two runs of n / 2, or those of the bits of n, the first times
    base to the length of what follows.
    """
    if len(values) < width:
        return np.zeros(0, dtype=_U)
    have, size = _folded(values & _U((1 << 62) - 1)), 1
    out, done = None, 0
    while True:
        if width & size:
            out, done = (have, size) if out is None else (_folded(times(have[: len(out) - size], pow(base, done, PRIME)) + out[size:]), done + size)
        if done == width:
            return out[: len(values) - width + 1]
        have = _folded(times(have[:-size], pow(base, size, PRIME)) + have[size:])
        size *= 2


@dataclass
class Words:
    """Words of a slice: byte positions in data, the row of each, its hash."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of the first word of each row, with the total at the end."""
        return np.searchsorted(self.row, np.arange(len(self.offsets)))

    def hashes(self, seed: int = SEEDS[0]) -> np.ndarray:
        """A hash of each word: its bytes, eight at once, each mixed into those before."""
        size = self.end - self.start
        c = eights(self.data)
        out = size.astype(_U) * _U(seed)
        out ^= _U(seed)
        live = np.flatnonzero(size <= LONG_WORD)
        k = 0
        while len(live):
            left = size[live] - k
            x = c[self.start[live] + k]
            short = left < 8
            x[short] &= (_U(1) << (_U(8) * left[short].astype(_U))) - _U(1)
            out[live] = mix((out[live] ^ x) * _U(0x9FB21C651E98DF25))
            live, k = live[left > 8], k + 8
        for i in np.flatnonzero(size > LONG_WORD):
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i] : self.end[i]].tobytes(), seed)
        return out


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its offsets from 0; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES of text."""
    _, offsets = buffer_of(column)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end
        at = end


def words_of(column: pa.Array, space: np.ndarray = _SPACE) -> Words:
    """Words of every row: [^\\x20\\x09-\\x0D]+, or what the given bytes leave."""
    data, offsets = buffer_of(column)
    inside = ~space[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, offsets, start, end, row)


def run_sums(values: np.ndarray, width: int) -> np.ndarray:
    """A cheap hash of each run of width values, modulo 2 ** 64: equal runs have equal ones, others may."""
    have, size, out, done = values, 1, None, 0
    while True:
        if width & size:
            out, done = (have, size) if out is None else (have[: len(out) - size] * _U(pow(BASES[0], done, 1 << 64)) + out[size:], done + size)
        if done == width:
            return out[: len(values) - width + 1]
        have = have[:-size] * _U(pow(BASES[0], size, 1 << 64)) + have[size:]
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of width values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
