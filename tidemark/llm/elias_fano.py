"""Elias-Fano sequences: monotone numbers in about two bits each plus their low bits, searched with numpy.

A value's low bits are packed one after the other; its high part is written in unary, as a one at bit
(high + its place). The zeros separate the runs of equal high parts, so the run of a high part lies
between two zeros, which a sampled directory of the zeros finds.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQ")
_WORDS = 8  # words of 64 bits from one entry of the directory to the next
_FIRST = np.array([[0] * 8 for _ in range(256)], dtype=np.uint8)
for _byte in range(256):
    _FIRST[_byte, : bin(_byte).count("1")] = [i for i in range(8) if _byte >> i & 1]
_U = np.uint64


def _bits(n: int) -> np.ndarray:
    return np.zeros((n + 63) // 64 + 1, dtype=np.uint64)


def encode(values: np.ndarray, universe: int) -> bytes:
    """The sequence of ``values``, which never fall and stay below ``universe``."""
    n = len(values)
    values = values.astype(np.uint64)
    width = max(0, (universe // max(1, n)).bit_length() - 1)
    low = _bits(n * width)
    if width:
        place = np.arange(n, dtype=np.uint64) * _U(width)
        part = values & _U((1 << width) - 1)
        word, offset = (place >> _U(6)).astype(np.int64), place & _U(63)
        np.bitwise_or.at(low, word, part << offset)
        over = offset + _U(width) > _U(64)
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - offset[over]))
    size = n + (universe >> width) + 1
    high = _bits(size)
    ones = (values >> _U(width)) + np.arange(n, dtype=np.uint64)
    np.bitwise_or.at(high, (ones >> _U(6)).astype(np.int64), _U(1) << (ones & _U(63)))
    high = np.concatenate([high, np.zeros(-len(high) % _WORDS, np.uint64)])
    zeros = 64 - np.bitwise_count(high).astype(np.int64)
    before = np.cumsum(zeros.reshape(-1, _WORDS).sum(axis=1)) - zeros.reshape(-1, _WORDS).sum(axis=1)
    return _HEAD.pack(n, universe, width) + b"".join(x.tobytes() for x in (low, high, before.astype("<u8")))


class Sequence:
    """A sequence in a buffer, which may be a mapped file."""

    def __init__(self, data, at: int = 0):
        self.n, self.universe, self.width = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        lows = (self.n * self.width + 63) // 64 + 1
        highs = (self.n + (self.universe >> self.width) + 1 + 63) // 64 + 1
        highs += -highs % _WORDS
        self.low = np.frombuffer(data, "<u8", lows, at)
        self.high = np.frombuffer(data, "<u8", highs, at + 8 * lows)
        self.zeros = np.frombuffer(data, "<u8", highs // _WORDS, at + 8 * (lows + highs)).view(np.int64)
        self.end = at + 8 * (lows + highs + highs // _WORDS)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        place = i.astype(np.uint64) * _U(self.width)
        word, offset = (place >> _U(6)).astype(np.int64), place & _U(63)
        second = np.where(offset == 0, _U(0), self.low[word + 1] << ((_U(64) - offset) & _U(63)))
        return ((self.low[word] >> offset) | second) & _U((1 << self.width) - 1)

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        """The bit of the k-th zero, from 0."""
        block = np.searchsorted(self.zeros, k, "right") - 1
        left, word = k - self.zeros[block], block * _WORDS
        for _ in range(_WORDS - 1):
            here = 64 - np.bitwise_count(self.high[word]).astype(np.int64)
            go = left >= here
            left, word = np.where(go, left - here, left), word + go
            if not go.any():
                break
        bits = ~self.high[word]
        shift = np.zeros(len(k), np.uint64)
        for _ in range(7):
            here = np.bitwise_count(bits & _U(255)).astype(np.int64)
            go = left >= here
            left = np.where(go, left - here, left)
            bits, shift = np.where(go, bits >> _U(8), bits), shift + go.astype(np.uint64) * _U(8)
        return word * 64 + shift.astype(np.int64) + _FIRST[(bits & _U(255)).astype(np.int64), left]

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value at or above each x, whether it equals x); the length if there is none."""
        x = x.astype(np.uint64)
        if not self.n or not len(x):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        inside = x < _U(self.universe)
        high = np.where(inside, x >> _U(self.width), _U(0)).astype(np.int64)
        stop = self._select_zero(high) - high
        start = np.where(high > 0, self._select_zero(np.maximum(high - 1, 0)) - np.maximum(high - 1, 0), 0)
        want, last = x & _U((1 << self.width) - 1), stop.copy()
        while True:
            open_ = np.flatnonzero(start < stop)
            if not len(open_):
                break
            middle = (start[open_] + stop[open_]) // 2
            less = self._low(middle) < want[open_]
            start[open_] = np.where(less, middle + 1, start[open_])
            stop[open_] = np.where(less, stop[open_], middle)
        equal = inside & (start < last)
        where = np.flatnonzero(equal)
        equal[where] = self._low(start[where]) == want[where]
        return np.where(inside, start, self.n), equal

    def value(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``, by a search over the high parts' directory."""
        lo, hi = np.zeros(len(i), np.int64), np.full(len(i), (self.universe >> self.width) + 1)
        while (lo < hi).any():  # the smallest high part whose run ends after the place
            middle = (lo + hi) // 2
            safe = np.minimum(middle, self.universe >> self.width)
            after = self._select_zero(safe) - safe > i
            active = lo < hi
            hi, lo = np.where(active & after, middle, hi), np.where(active & ~after, middle + 1, lo)
        return (lo.astype(np.uint64) << _U(self.width)) | self._low(i)
