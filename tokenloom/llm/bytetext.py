"""Whole texts of an Arrow batch as bytes, words and word shingles in numpy.

A *piece* is some neighbouring texts of a batch: their UTF-8 bytes in one array
and the offset at which each text begins.  A null text is an empty one.  Pieces
hold about ``PIECE`` bytes, or one longer text, so memory stays bounded whatever
a batch holds.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_MUL = 0xD1342543DE82EF95
_INV = pow(_MUL, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _A)


class Kept(dict):
    """What a process keeps for later calls; it goes nowhere with the functions that use it."""

    def __reduce__(self):
        return dict, ()


_powers: dict[int, np.ndarray] = Kept()


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64; kept for later calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE * 2), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and the ``len + 1`` offsets of its values."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, end, bytes, offsets)`` for runs of rows of about ``size`` bytes."""
    data, off = text_bytes(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def runs(flags: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end positions of the runs of true flags; no run crosses a text's border."""
    n = len(flags)
    before, after = np.empty(n, bool), np.empty(n, bool)
    if n:
        before[0] = after[-1] = False
        before[1:], after[:-1] = flags[:-1], flags[1:]
        before[off[:-1][off[:-1] < n]] = False
        last = off[1:] - 1
        after[last[last >= 0]] = False
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1


class Words:
    """The words of a piece: ``start``, ``end``, and ``bound[i]:bound[i+1]`` of text ``i``."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        self.start, self.end = runs(~SPACE[data], off)
        self.bound = np.searchsorted(self.start, off)
        self.text = np.repeat(np.arange(len(off) - 1), np.diff(self.bound))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        return span_hashes(prefix_hash(self.data), self.start, self.end)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: ``out[i]`` covers ``data[:i]``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(_MUL, len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans ``start:end``; equal spans have equal hashes wherever they stand."""
    inverse = powers(_INV, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64) * _A)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words and the bounds of each text's runs.

    A text of fewer words has its whole sequence as one run, an empty text none.
    """
    h = words.hashes()
    count = np.diff(words.bound)
    g = h.copy()
    for j in range(1, width):
        n = max(len(h) - j, 0)
        g[:n] = mix(g[:n] * _A + h[j : j + n])
    whole = np.maximum(count - width + 1, 0)
    keep = np.zeros(len(h), bool)
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, words.bound[:-1], 1)
    np.add.at(edge, words.bound[:-1] + whole, -1)
    keep = np.cumsum(edge)[:-1] > 0
    short = np.flatnonzero((count > 0) & (count < width))
    for i in short:
        lo = words.bound[i]
        value = h[lo : lo + 1]
        for j in range(1, count[i]):
            value = mix(value * _A + h[lo + j : lo + j + 1])
        g[lo] = mix(value + np.uint64(int(count[i])))[0]
        keep[lo] = True
    total = np.where(count < width, np.minimum(count, 1), whole)
    return g[keep], np.concatenate([[0], np.cumsum(total)])


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit words as Spark's long."""
    return h.view(np.int64)


def digest(h: np.ndarray) -> tuple[int, int]:
    """128 bits of an array of words, as two longs."""
    a, b = np.frombuffer(hashlib.blake2b(h.tobytes(), digest_size=16).digest(), np.int64)
    return int(a), int(b)


def binary(values: list[bytes | np.ndarray]) -> pa.Array:
    return pa.array([v if isinstance(v, bytes) else v.tobytes() for v in values], pa.binary())


def give_back() -> None:
    """Hand what numpy and Arrow have freed back to the system.

    Spark keeps a Python worker for later tasks, and it would keep the most that
    any of them took.  C libraries other than glibc's hand back nothing here.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
