"""Token ids of whole texts in binary files, in key order.

Texts are sorted by key over the cluster; each partition writes one file of segments, and each
segment (``rans``) holds whole documents: their keys, their lengths and their ids. A manifest of the
segments gives every document's place in the stream of all ids and makes the files readable in
parallel.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, rans, storage, vocabulary
from tidemark.llm.words import Cut, distinct, gather, spans_of
from tidemark.session import materialise

SEGMENT_IDS = 1 << 21
_SEGMENT = struct.Struct("<II")
MANIFEST = "partition int, segment int, uri string, start long, length long, documents long, ids long"


def pack_segment(keys: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """Keys (with a mark for nulls), lengths and ids of some documents."""
    known = np.array([k is not None for k in keys], dtype=np.uint8)
    column = np.array([0 if k is None else k for k in keys], dtype="<i8")
    index = zlib.compress(known.tobytes() + column.tobytes() + lengths.astype("<u8").tobytes(), 1)
    return _SEGMENT.pack(len(keys), len(index)) + index + rans.encode(ids)


def unpack_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    n, size = _SEGMENT.unpack_from(data)
    index = zlib.decompress(data[_SEGMENT.size : _SEGMENT.size + size])
    known = np.frombuffer(index, np.uint8, n)
    keys = np.frombuffer(index, "<i8", n, n).tolist()
    lengths = np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64)
    return [k if ok else None for k, ok in zip(keys, known)], lengths, rans.decode(data[_SEGMENT.size + size :])


def unit_ids(docs: DataFrame, folder: str, tokenizer: str, text: str) -> tuple[list[tuple[int, str]], int]:
    """The lookup table of all distinct units of the texts to their ids: its files, one a shard, and shard bits."""
    bits = vocabulary.shard_bits(docs, text)

    def payload(batch: pa.RecordBatch) -> list[bytes | None]:
        encoder = bpe.encoder(tokenizer)
        return [None if w is None else encoder.unit(w.decode()) for w in batch.column("word").to_pylist()]

    units = vocabulary.packed_spans(docs, text, bpe.cut_units, bits)
    manifest = materialise(vocabulary.write_table(units, folder, payload, vocabulary.merging(bits)), "units")
    return [(r.shard, r.uri) for r in manifest.select("shard", "uri").collect()], bits


def encode_column(column: pa.Array, cut: Cut, units: vocabulary.Table, whole, end_id: int | None) -> Iterator[tuple]:
    """(ids, number of ids of each text, spans) of consecutive texts, each ending with ``end_id`` if there is one.

    Texts with a span that the table lacks go to ``whole``, which gives the ids of texts as bytes.
    """
    for spans in spans_of(column, cut):
        keys, inverse = distinct(spans.key)
        found, length, values = units.find(keys, np.dtype("<u4"))
        start, bounds = np.cumsum(length) - length, spans.bounds()
        own = length[inverse]
        ids = gather(values, start[inverse], own)
        ends = np.concatenate(([0], np.cumsum(own)))[bounds]
        lost = np.concatenate(([0], np.cumsum(~found[inverse])))[bounds]
        slow = np.flatnonzero(np.diff(lost)).tolist()
        if slow:
            raw, parts = spans.raw.tobytes(), []
            known = dict(zip(slow, whole([raw[spans.offsets[i] : spans.offsets[i + 1]].decode() for i in slow])))
            for i in range(spans.texts):
                parts.append(np.frombuffer(known[i], "<u4") if i in known else ids[ends[i] : ends[i + 1]])
            ids = np.concatenate(parts)
            ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        if end_id is None:
            yield ids, np.diff(ends), spans
        else:
            yield np.insert(ids, ends[1:], end_id), np.diff(ends) + 1, spans


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    partition_bytes: int = 32 << 20,
) -> DataFrame:
    """A DataFrame that, when it runs, writes the files and returns their manifest.

    Documents come in ascending order of the key, nulls first, equal keys in order of their texts; null
    and empty texts have only the end id. ``tokenizer`` is the path of a JSON file that every
    executor has. Each distinct unit of the corpus is encoded once, beforehand, into a lookup table in
    ``folder``; texts with units that depend on their neighbours go through the library whole.
    Partitions hold about ``partition_bytes`` of text. Write the manifest down once: a task that ran
    twice leaves a file that no manifest names.
    """
    files, bits = unit_ids(docs, f"{folder}/units", tokenizer, text)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    place = [F.col("key").asc_nulls_first(), F.crc32(F.col("text").cast("binary"))]
    ordered = rows.repartitionByRange(max(1, -(-total // partition_bytes)), *place)
    ordered = ordered.sortWithinPartitions(F.col("key").asc_nulls_first(), place[1], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, units = bpe.encoder(tokenizer), vocabulary.table(files, bits)
        uri = storage.fresh(folder, ".ids")
        keys, counts, parts, held, rows, at = [], [], [], 0, [], 0
        with storage.create(uri) as file:

            def flush() -> None:
                nonlocal keys, counts, parts, held, at
                data = pack_segment(keys, np.concatenate(counts), np.concatenate(parts))
                file.write(data)
                rows.append((TaskContext.get().partitionId(), len(rows), uri, at, len(data), len(keys), held))
                keys, counts, parts, held, at = [], [], [], 0, at + len(data)

            for batch in batches:
                own, first = batch.column("key").to_pylist(), 0
                for ids, lengths, _ in encode_column(batch.column("text"), bpe.cut_units, units, encoder.whole, end_id):
                    keys += own[first : first + len(lengths)]
                    counts.append(lengths)
                    parts.append(ids)
                    held, first = held + len(ids), first + len(lengths)
                    if held >= SEGMENT_IDS:
                        flush()
            if keys:
                flush()
        if rows:
            names = [part.split()[0] for part in MANIFEST.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return ordered.mapInArrow(run, MANIFEST)


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``before``: all ids in front of the segment.

    Running totals within each partition, and over the one row that each partition has.
    """
    inside = Window.partitionBy("partition").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    totals = manifest.groupBy("partition").agg(F.sum("ids").alias("sum"))
    across = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("partition", F.coalesce(F.sum("sum").over(across), F.lit(0)).alias("offset"))
    local = manifest.withColumn("inside", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return local.join(offsets, "partition").withColumn("before", F.col("offset") + F.col("inside"))


def read_ids(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids_crc32 and, if asked for, ids) of every document in the files."""
    schema = "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, at, length, before in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "length", "before"))):
                with storage.RangeReader(uri) as file:
                    keys, lengths, ids = unpack_segment(file.read(at, length))
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                arrays = [
                    pa.array(keys, pa.int64()),
                    pa.array(before + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(arrays, [part.split()[0] for part in schema.split(", ")])

    # a fixed number of partitions: the rows are few and small, but each stands for megabytes
    partitions = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_starts(manifest).repartition(partitions, "uri", "start").mapInArrow(run, schema)
