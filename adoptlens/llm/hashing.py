"""Vectorised hashing of texts inside tasks.

A block is a run of documents laid end to end in one byte buffer. Symbols are its bytes or
its words; every function works on whole symbol arrays of a block, so a task holds one block
at a time however many documents it reads.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_CODE = np.random.default_rng(20).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: Space and the control characters 9 to 13.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    got = _POWERS.get(int(base))
    if got is None or len(got) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        got = np.full(size, base, np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        _POWERS[int(base)] = got
    return got[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums, from which ``range_hash`` takes any range."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _powers(BASE, len(codes)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the symbols in [start, end) for each pair; it depends on these symbols alone."""
    inverse = _powers(BASE_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def _append(head: np.ndarray, tail: np.ndarray, width: int) -> np.ndarray:
    n = min(len(head), len(tail))
    return head[:n] * np.uint64(pow(int(BASE), width, 1 << 64)) + tail[:n]


def gram_hash(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` symbols from each position on (empty if there are fewer)."""
    if len(codes) < k:
        return np.zeros(0, np.uint64)
    total, done, part, width = None, 0, codes, 1
    while done < k:
        if k & width:
            total = part if total is None else _append(total, part[done:], width)
            done += width
        if done < k:
            part = _append(part, part[width:], width)
            width *= 2
    return mix(total[: len(codes) - k + 1])


def word_bounds(buf: np.ndarray, is_separator: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word, a maximal run of bytes that are no separators."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~is_separator[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_codes(buf: np.ndarray, is_separator: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of a byte buffer."""
    start, end = word_bounds(buf, is_separator)
    return range_hash(prefix_sums(BYTE_CODE[buf]), start, end), start, end


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value in each window of ``width`` values."""
    low, at, a = values, np.arange(len(values), dtype=np.int32), 1

    def merged(shift: int):
        n = len(low) - shift
        left = low[:n] <= low[shift:]
        return np.where(left, low[:n], low[shift:]), np.where(left, at[:n], at[shift:])

    while 2 * a <= width:
        low, at = merged(a)
        a *= 2
    if a < width:
        low, at = merged(width - a)
    return at
