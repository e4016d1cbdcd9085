"""Words and other spans of whole Arrow text columns, with 64-bit keys, by numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_RADIX = 0x9E3779B97F4A7C15


def byte_table(word_bytes) -> np.ndarray:
    """A table of 256 that is true for the bytes of words."""
    table = np.zeros(256, dtype=bool)
    table[list(word_bytes)] = True
    return table


#: Everything but the blank and the five control characters 0x09 to 0x0D.
NOT_SPACE = byte_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: Digits, letters and every byte of a character beyond ASCII.
ALPHANUMERIC = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Bytes of words become their lower-case form, all others a blank.
NORMAL = bytes(int(LOWER[b]) if ALPHANUMERIC[b] else 0x20 for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters (lower-cased) and characters beyond ASCII."""
    return text.translate(NORMAL).split()


#: (bytes, offsets of the texts) to the spans' starts and ends; no span crosses a text's edge.
Cut = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (an invertible mixing function)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; nulls are empty texts."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def gather(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The elements of many ranges of ``raw``, one range after the other."""
    place = np.repeat(start - (np.cumsum(length) - length), length)
    place += np.arange(len(place))
    return raw[place]


def binary_array(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow array."""
    length = end - start
    offsets = np.zeros(len(start) + 1, dtype=np.int32)
    np.cumsum(length, out=offsets[1:])
    data = gather(raw, start, length)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class Spans:
    """Spans of some consecutive texts: which text, where in its bytes, and their keys."""

    __slots__ = ("first", "texts", "start", "end", "key", "raw", "offsets")

    def __init__(self, first, start, end, key, raw, offsets):
        self.first, self.texts = first, len(offsets) - 1
        self.start, self.end, self.key, self.raw, self.offsets = start, end, key, raw, offsets

    def text(self) -> np.ndarray:
        """The number of each span's text, from 0 for the first of the chunk."""
        return np.searchsorted(self.offsets, self.start, "right") - 1

    def bounds(self) -> np.ndarray:
        """Where each text's spans begin among all, and the end."""
        return np.searchsorted(self.start, self.offsets)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the radix and of its inverse, modulo 2**64."""
    global _CACHED
    if len(_CACHED[0]) < n:
        both = []
        for base in (_RADIX, pow(_RADIX, -1, 1 << 64)):
            factors = np.full(n, base, dtype=np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        _CACHED = tuple(both)
    return _CACHED


_CACHED = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def keys_of(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit keys of byte ranges; different ranges share one with a probability of about 2**-64."""
    powers, inverse = _powers(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, dtype=np.uint64)
    terms = prefix[1:]
    np.add(raw, np.uint64(1), out=terms, dtype=np.uint64)
    terms *= powers[: len(raw)]
    np.cumsum(terms, out=terms)
    length = (end - start).astype(np.uint64)
    return mixed((prefix[end] - prefix[start]) * inverse[start] + length * np.uint64(0xA24BAED4963EE407))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and where among them each key stands; by a hash table, since most keys repeat."""
    found = pa.array(keys).dictionary_encode()
    unordered = found.dictionary.to_numpy()
    order = np.argsort(unordered)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return unordered[order], place[found.indices.to_numpy()]


def cut_words(table: np.ndarray) -> Cut:
    """Maximal runs of the bytes that ``table`` marks."""

    def cut(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = len(raw)
        inside = np.zeros(size + 1, dtype=bool)
        inside[:size] = table[raw]
        opens = inside[:size].copy()
        opens[1:] &= ~inside[: size - 1]
        closes = inside[:size] & ~inside[1:]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        opens[heads] = inside[heads]
        closes[heads[1:] - 1] = inside[heads[1:] - 1]
        return np.flatnonzero(opens), np.flatnonzero(closes) + 1

    return cut


def spans_of(column: pa.Array, cut: Cut, lower: bool = False, chunk: int = CHUNK_BYTES) -> Iterator[Spans]:
    """The spans of a text column, in chunks of about ``chunk`` bytes of whole texts.

    With ``lower`` the bytes A to Z are lower-cased first.
    """
    offsets, raw = text_buffer(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + chunk, "right")) - 1)
        part = raw[offsets[first] : offsets[last]]
        own = offsets[first : last + 1] - offsets[first]
        if lower:
            part = LOWER[part]
        start, end = cut(part, own)
        yield Spans(first, start, end, keys_of(part, start, end), part, own)
        first = last
