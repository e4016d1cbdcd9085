"""Benchmark decontamination with one Aho-Corasick automaton over normalised windows.

Texts are lower-cased (A-Z) and cut into words of digits, ASCII letters and all characters
beyond ASCII. Every window of some consecutive words of a benchmark item becomes a pattern; each
document is scanned once; what is found is mapped back to words and to characters of the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import storage
from tidemark.llm.words import NORMAL, normal_words
from tidemark.session import materialise, scratch_path


def windows(text: bytes, width: int) -> list[bytes]:
    """All windows of ``width`` words, or the one shorter window of a shorter text; none of no words."""
    words = normal_words(text)
    if not words:
        return []
    return [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def automaton(items: list[tuple[object, bytes]], width: int) -> ahocorasick.Automaton:
    """Patterns are windows between blanks; a pattern's value is (number of words, items that have it)."""
    owners: dict[bytes, set] = {}
    for item_id, text in items:
        for window in windows(text, width):
            owners.setdefault(window, set()).add(item_id)
    built = ahocorasick.Automaton()
    for window, ids in owners.items():
        built.add_word((b" " + window + b" ").decode("latin-1"), (window.count(b" ") + 1, tuple(ids)))
    if owners:
        built.make_automaton()
    return built


def scan(text: bytes, found: ahocorasick.Automaton) -> tuple[int, np.ndarray, set]:
    """(number of words, which of them lie in an occurrence, items whose windows occur)."""
    words = normal_words(text)
    marks, items = np.zeros(0, dtype=bool), set()
    if words and len(found):
        # bytes as characters: all offsets are byte offsets, and no character can be torn
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        ends = None
        for end, (count, ids) in found.iter(line):
            if ends is None:
                marks = np.zeros(len(words), dtype=bool)
                ends = np.cumsum([len(word) + 1 for word in words])
            last = int(np.searchsorted(ends, end))
            marks[last - count + 1 : last + 1] = True
            items.update(ids)
    return len(words), marks, items


def character_spans(text: bytes, marks: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of the original text (end excluded) that hold runs of marked words."""
    if not marks.any():
        return []
    raw = np.frombuffer(text.translate(NORMAL), dtype=np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([False], raw, [False]))))
    starts, ends = edges[::2], edges[1::2]
    runs = np.flatnonzero(np.diff(np.concatenate(([False], marks, [False])).astype(np.int8)))
    place = lambda at: len(text[:at].decode("utf-8"))
    return [(place(starts[a]), place(ends[b - 1])) for a, b in zip(runs[::2], runs[1::2])]


_RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_words", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_BUILT: dict[tuple, ahocorasick.Automaton] = {}


def _automaton(uris: tuple[str, ...], width: int) -> ahocorasick.Automaton:
    """The automaton of one block's files, one per worker process."""
    if (uris, width) not in _BUILT:
        _BUILT.clear()
        items: list[tuple[object, bytes]] = []
        for uri in uris:
            system, path = storage.resolve(uri)
            with system.open_input_file(path) as file:
                block = pq.read_table(file)
            items += zip(block.column("item_id").to_pylist(), block.column("text").cast(pa.binary()).to_pylist())
        _BUILT[uris, width] = automaton(items, width)
    return _BUILT[uris, width]


def _found(counts, hits, items, spans) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPANS)],
        names=_RESULT.names,
    )


def _scanner(uris: tuple[str, ...], width: int, only_hits: bool = False) -> storage.Run:
    """Adds what one block's windows hit to each row, or, without spans, to the rows that they hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _automaton(uris, width)
        for batch in batches:
            counts, hits, items, spans = [], [], [], []
            for body in storage.strings(batch.column("_text")):
                n, marks, ids = scan(body, found)
                counts.append(n)
                hits.append(np.flatnonzero(marks).astype(np.int32))
                items.append(sorted(ids))
                spans.append([{"start": a, "end": b} for a, b in character_spans(body, marks)] if len(marks) and not only_hits else [])
            kept = [c for c in batch.schema.names if c != "_text"]
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), _found(counts, hits, items, spans)], names=[*kept, "found"])
            yield out.filter(pa.array([len(h) > 0 for h in hits])) if only_hits else out

    return storage.trimmed(run)


def _spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole result of each row (_text, hit_words, items) from what all blocks hit."""
    for batch in batches:
        counts, hits, spans = [], [], []
        for body, hit in zip(storage.strings(batch.column("_text")), batch.column("hit_words").to_pylist()):
            counts.append(len(normal_words(body)))
            marks = np.zeros(counts[-1], dtype=bool)
            marks[hit or []] = True
            hits.append(hit or [])
            spans.append([{"start": a, "end": b} for a, b in character_spans(body, marks)])
        items = [found or [] for found in batch.column("items").to_pylist()]
        kept = [c for c in batch.schema.names if c not in ("_text", "hit_words", "items")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), _found(counts, hits, items, spans)], names=[*kept, "found"])


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[tuple[str, ...]]:
    """The files of each block of distinct items (item_id, text); a block's automaton fits into memory.

    Items are dealt by hash and never cut. They go from the table to files; only the files' names reach the driver.
    """
    named = benchmark.select(
        F.coalesce(benchmark[item_id].cast("string"), F.lit("None")).alias("item_id"),
        F.coalesce(benchmark[text].cast("string"), F.lit("")).alias("text"),
    )
    items = materialise(named.distinct(), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = items.repartitionById(blocks, F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    folder = scratch_path(benchmark.sparkSession, "benchmark")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        for batch in batches:
            uri = storage.fresh(folder, ".parquet")
            with storage.create(uri) as file:
                pq.write_table(pa.Table.from_batches([batch]), file)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "uri": [uri]})

    manifest = materialise(dealt.mapInArrow(write, "block int, uri string"), "blocks")
    files: dict[int, list[str]] = {}
    for row in manifest.collect():
        files.setdefault(row.block, []).append(row.uri)
    return [tuple(sorted(files[block])) for block in sorted(files)] or [()]


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """The ``keep`` columns and ``found``: n_words, hit_words (their numbers), items, spans (characters).

    A null or empty text has no words and no hits; so has a text without benchmark items. Items of
    fewer words than ``width`` are one window, items without words none; a null item_id reads
    "None". A repeated item counts once, repeated rows are kept as they are, and very long texts are scanned whole. The
    benchmark lies in blocks of about ``block_bytes`` of distinct text, each with an automaton of its own, which a task reads
    when it scans with it. With several blocks the documents are scanned once for each; what the blocks hit is united by row,
    and the spans are those of all hit words together, as with one block.
    """
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].alias("_text"))
    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, keep)), T.StructField("found", _RESULT)])
    blocks = item_blocks(benchmark, item_id, item_text, block_bytes)
    if len(blocks) == 1:
        out = rows.mapInArrow(_scanner(blocks[0], width), schema)
    else:
        numbered = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "documents")
        hit = T.StructType([T.StructField("_row", T.LongType()), T.StructField("found", _RESULT)])
        parts = [numbered.select("_row", "_text").mapInArrow(_scanner(uris, width, only_hits=True), hit) for uris in blocks]
        united = parts[0]
        for part in parts[1:]:
            united = united.unionByName(part)
        merged = united.groupBy("_row").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("found.hit_words")))).alias("hit_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("found.items")))).alias("items"),
        )
        out = numbered.join(materialise(merged, "hits"), "_row", "left").select(*names, "_text", "hit_words", "items")
        out = out.mapInArrow(storage.trimmed(_spanned), schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "found")
