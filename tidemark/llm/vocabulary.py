"""The distinct spans of a corpus, and lookup tables over them that tasks map into memory.

Each task reduces its spans to distinct ones with counts and sends them, packed, to the shard that
the top bits of their keys name; a shard merges what it gets. A lookup table is one sorted file a
shard, which readers search without holding it in memory of their own.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import storage
from tidemark.llm.words import CHUNK_BYTES, Cut, binary_array, distinct, gather, spans_of

#: Distinct spans that a task holds before it merges and sends them.
HELD = 400_000
SHARD_BYTES, MOST_SHARDS = 24 << 20, 4096
PACKED = "shard int, data binary"
VOCABULARY = "shard int, key long, word binary, n long"


def shard_bits(docs: DataFrame, text: str) -> int:
    """Bits of a shard's number: more shards for more text. They only set how the work is dealt out."""
    storage.small_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return min(MOST_SHARDS, max(4, total // SHARD_BYTES)).bit_length()


class _Distinct:
    """Distinct keys with their words and counts, merged as they come."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, key: np.ndarray, count: np.ndarray, length: np.ndarray, data: np.ndarray) -> None:
        self.parts.append((key, count, length, data))
        self.rows += len(key)

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys, counts, lengths and bytes of the words; keys that two words share get the length -1."""
        if not self.parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint8)
        if len(self.parts) == 1:
            return self.parts[0]
        key, count, length, data = (np.concatenate(x) for x in zip(*self.parts))
        start = np.cumsum(np.maximum(length, 0)) - np.maximum(length, 0)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.add.reduceat(count[order], heads)
        first, lengths = order[heads], length[order]
        kept = lengths[heads]
        # two words of one key differ in length, or else in their bytes (compared where lengths agree)
        low, high = np.minimum.reduceat(lengths, heads), np.maximum.reduceat(lengths, heads)
        check = _checks(data, start, np.maximum(length, 0))[order]
        same = (low == high) & (np.minimum.reduceat(check, heads) == np.maximum.reduceat(check, heads))
        words = gather(data, start[first], np.where(same, np.maximum(kept, 0), 0))
        self.parts = [(ordered[heads], counts, np.where(same, kept, -1), words)]
        self.rows = len(heads)
        return self.parts[0]


def _checks(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A second number of each word, by another rule than its key: weighted sums of the bytes by place."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = total[1:]
    terms[:] = np.arange(len(data), dtype=np.uint64)
    terms -= np.repeat(start.astype(np.uint64), length)
    terms *= terms
    terms += np.uint64(7919)
    terms *= data.astype(np.uint16) + np.uint16(1)
    np.cumsum(terms, out=terms)
    return total[start + length] - total[start]


def _pack(key, count, length, data) -> bytes:
    head = struct.pack("<QQ", len(key), len(data))
    plain = b"".join((key.tobytes(), count.astype("<i8").tobytes(), length.astype("<i4").tobytes(), data.tobytes()))
    return head + zstandard.ZstdCompressor(level=1).compress(plain)


def _unpack(blob: bytes):
    n, size = struct.unpack_from("<QQ", blob)
    plain = zstandard.ZstdDecompressor().decompress(blob[16:], max_output_size=20 * n + size)
    parts = np.frombuffer(plain, "<u8", n), np.frombuffer(plain, "<i8", n, 8 * n)
    return *parts, np.frombuffer(plain, "<i4", n, 16 * n).astype(np.int64), np.frombuffer(plain, np.uint8, size, 20 * n)


def packed_spans(
    docs: DataFrame, text: str, cut: Cut, bits: int, lower: bool = False, most: int = HELD, chunk: int = CHUNK_BYTES
) -> DataFrame:
    """The distinct spans of each task, packed, at the shards that hold their keys: one partition a shard.

    Null and empty texts have no spans. A task holds about ``most`` distinct spans and cuts ``chunk`` bytes at a time.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Distinct()

        def send() -> pa.RecordBatch:
            key, count, length, data = held.merged()
            ends = np.cumsum(np.maximum(length, 0))
            edges = np.searchsorted(key >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            shards = np.flatnonzero(np.diff(edges))
            blobs = []
            for a, b in zip(edges[shards], edges[shards + 1]):
                blobs.append(_pack(key[a:b], count[a:b], length[a:b], data[ends[a] - max(length[a], 0) : ends[b - 1]]))
            held.parts, held.rows = [], 0
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "data"])

        for batch in batches:
            for spans in spans_of(batch.column(0), cut, lower, chunk):
                key, inverse = distinct(spans.key)
                first, count = np.empty(len(key), dtype=np.int64), np.bincount(inverse, minlength=len(key))
                first[inverse] = np.arange(len(inverse))
                start, end = spans.start[first], spans.end[first]
                held.add(key, count.astype(np.int64), end - start, gather(spans.raw, start, end - start))
                if held.rows > most:
                    held.merged()
                    if held.rows > most // 2:
                        yield send()
        if held.rows:
            held.merged()
            yield send()

    packed = docs.select(docs[text].alias("text")).mapInArrow(storage.trimmed(local), PACKED)
    return packed.repartitionById(1 << bits, F.col("shard"))


def merging(bits: int, most: int = HELD) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merges what a shard was sent: rows (shard, key, word, n) in order of the unsigned key.

    The word is null for a key that two different words have.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Distinct()
        for batch in batches:
            for blob in batch.column("data").to_pylist():
                held.add(*_unpack(blob))
                if held.rows > 2 * most:
                    held.merged()
        key, count, length, data = held.merged()
        ends = np.cumsum(np.maximum(length, 0))
        shard = key >> np.uint64(64 - bits)
        for a in range(0, len(key), 50_000):
            b = min(len(key), a + 50_000)
            own = np.maximum(length[a:b], 0)
            words = binary_array(data, ends[a:b] - own, ends[a:b])
            if (length[a:b] < 0).any():
                words = pa.array([None if bad else w for w, bad in zip(words.to_pylist(), length[a:b] < 0)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[a:b].astype(np.int32)), pa.array(key[a:b].view(np.int64)), words, pa.array(count[a:b])],
                ["shard", "key", "word", "n"],
            )

    return storage.trimmed(merge)


def distinct_spans(
    docs: DataFrame, text: str, cut: Cut, bits: int, lower: bool = False, most: int = HELD, chunk: int = CHUNK_BYTES
) -> DataFrame:
    """(shard, key, word, n) of all distinct spans; the word is null for a key that two words have."""
    return packed_spans(docs, text, cut, bits, lower, most, chunk).mapInArrow(merging(bits, most), VOCABULARY)


def write_table(
    rows: DataFrame,
    folder: str,
    payload: Callable[[pa.RecordBatch], list[bytes | None]],
    prepare: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter,
) -> DataFrame:
    """Write one sorted file a partition, which is one shard, and return (shard, uri, n, total).

    ``n`` is the number of keys; ``total`` sums the column ``n`` of the rows, if they have it.

    ``prepare`` makes rows with at least (shard, key) of the partition's batches, such as ``merging`` does of
    ``packed_spans``; ``payload`` gives each row's value, and None leaves the key out. Write the
    manifest down before use.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lengths, values, shard, total = [], [], [], None, 0
        for batch in prepare(batches):
            found = payload(batch)
            known = np.array([v is not None for v in found], dtype=bool)
            keys.append(batch.column("key").to_numpy().view(np.uint64)[known])
            lengths.append(np.array([len(v) for v in found if v is not None], dtype=np.int64))
            values.append(b"".join(v for v in found if v is not None))
            shard = batch.column("shard")[0].as_py() if batch.num_rows else shard
            if "n" in batch.schema.names and batch.num_rows:
                total += pc.sum(batch.column("n")).as_py()
        if shard is None:
            return
        key, length = np.concatenate(keys), np.concatenate(lengths)
        order = np.argsort(key, kind="stable")
        if not (order[1:] > order[:-1]).all():
            raw = np.frombuffer(b"".join(values), np.uint8)
            values = [gather(raw, (np.cumsum(length) - length)[order], length[order]).tobytes()]
            key, length = key[order], length[order]
        uri = storage.fresh(folder, ".table")
        with storage.create(uri) as file:
            file.write(struct.pack("<QQ", len(key), sum(map(len, values))))
            file.write(key.astype("<u8").tobytes())
            file.write(np.concatenate(([0], np.cumsum(length))).astype("<u8").tobytes())
            for value in values:
                file.write(value)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "uri": [uri], "n": pa.array([len(key)]), "total": pa.array([total])})

    return rows.mapInArrow(storage.trimmed(run), "shard int, uri string, n long, total long")


class Table:
    """A lookup table from its manifest rows: at most one (shard, uri) a shard, ``bits`` bits of shard."""

    def __init__(self, files: list[tuple[int, str]], bits: int):
        self.bits, self.uris, self.open = bits, dict(files), {}

    def _shard(self, shard: int):
        if shard not in self.open:
            data = storage.mapped(self.uris[shard])
            n, size = struct.unpack_from("<QQ", data)
            keys, offsets = np.frombuffer(data, "<u8", n, 16), np.frombuffer(data, "<u8", n + 1, 16 + 8 * n)
            self.open[shard] = keys, offsets.view(np.int64), np.frombuffer(data, np.uint8, size, 24 + 16 * n)
        return self.open[shard]

    def find(self, keys: np.ndarray, unit: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted distinct keys: (found, lengths in units, all values in a row)."""
        unit = np.dtype(unit)
        found, lengths, parts = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64), []
        edges = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        for shard in np.flatnonzero(np.diff(edges)).tolist():
            if shard not in self.uris:
                continue
            table, offsets, values = self._shard(shard)
            if not len(table):
                continue
            a, b = edges[shard], edges[shard + 1]
            at = np.minimum(np.searchsorted(table, keys[a:b]), len(table) - 1)
            hit = table[at] == keys[a:b]
            at = at[hit]
            found[a:b] = hit
            length = (offsets[at + 1] - offsets[at]) // unit.itemsize
            lengths[a:b][hit] = length
            parts.append(gather(values.view(unit), offsets[at] // unit.itemsize, length))
        return found, lengths, np.concatenate(parts) if parts else np.empty(0, unit)




_TABLES: dict[str, Table] = {}


def table(files: list[tuple[int, str]], bits: int) -> Table:
    """The worker process's view of a table, kept from task to task."""
    token = "".join(uri for _, uri in files)
    if token not in _TABLES:
        _TABLES.clear()
        _TABLES[token] = Table(files, bits)
    return _TABLES[token]
