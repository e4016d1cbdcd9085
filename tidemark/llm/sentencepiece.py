"""SentencePiece encoding by a relational lattice, and decoding.

Texts are cut where no piece of the model spans, so that the parts encode on their own; each
distinct part of the corpus is encoded once. Its bounded-length substrings are exploded and
equi-joined to the piece table; the edges are grouped by part, and a higher-order ``aggregate`` folds
them into the best segmentation. A lookup table of the parts then encodes whole texts.

For unigram models the fold is Viterbi's. Byte-pair models have no additive scores: their best
segmentation is what merging gives, so for them the fold merges, best edge first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import storage, token_files, vocabulary
from tidemark.llm.words import Cut, gather
from tidemark.session import materialise, scratch_path

SPACE = "▁"
UNIGRAM, BPE = 1, 2
_NORMAL, _BYTE = 1, 6
#: Longer parts do not fit the bit mask of the fold; their texts go through the library.
MOST_CHARACTERS = 48
#: Distinct parts that a task holds, and bytes it cuts at a time: the fold's executor needs its memory for the lattice.
HELD, CHUNK_BYTES = 400_000, 1 << 19
#: Tasks that fold the parts of one shard.
FOLD_TASKS = 4


@dataclass
class Pieces:
    """The piece table of a model: at most some ten thousand rows, whatever the data."""

    kind: int
    rows: list[tuple[str, int, float]]
    first_byte: int
    texts: list[bytes]

    @property
    def longest(self) -> int:
        return max(len(piece) for piece, _, _ in self.rows)


def read_pieces(path: str) -> Pieces:
    """The model's pieces. Models that normalise, or that have no byte pieces, are not supported."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("the model normalises its texts")
    rows = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == _NORMAL]
    numbers = [i for i, p in enumerate(model.pieces) if p.type == _BYTE]
    if len(numbers) != 256 or numbers != list(range(numbers[0], numbers[0] + 256)):
        raise ValueError("the model has no run of byte pieces")
    texts = [b"" for _ in model.pieces]
    for piece, i, _ in rows:
        texts[i] = piece.replace(SPACE, " ").encode()
    for b in range(256):
        texts[numbers[0] + b] = bytes([b])
    return Pieces(model.trainer_spec.model_type, rows, numbers[0], texts)


def cut_parts(pieces: Pieces) -> Cut:
    """Cuts between two characters that stand side by side in no piece (told by the bytes that meet there)."""
    apart = np.ones((256, 256), dtype=bool)
    for piece, _, _ in pieces.rows:
        characters = [c.encode() for c in piece.replace(SPACE, " ")]
        for a, b in zip(characters, characters[1:]):
            apart[a[-1], b[0]] = False

    def cut(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(raw):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        edge = np.zeros(len(raw), dtype=bool)
        edge[1:] = apart[raw[:-1], raw[1:]] & ((raw[1:] & 0xC0) != 0x80)
        edge[offsets[:-1][offsets[:-1] < len(raw)]] = True
        start = np.flatnonzero(edge)
        return start, np.append(start[1:], len(raw))

    return cut


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _merged(n: Column, edges: Column) -> Column:
    """The mask of starts that merging leaves: each step merges the best edge that two pieces fill."""

    def step(mask: Column, _: Column) -> Column:
        fits = F.filter(
            edges,
            lambda e: (mask.bitwiseAND(e["full"]) == e["full"]) & (F.bit_count(mask.bitwiseAND(e["inner"])) == 1),
        )
        return F.coalesce(mask.bitwiseAND(F.bitwise_not(F.get(fits, F.lit(0))["inner"])), mask)

    start = _bit(n + 1) - 1  # a start at every character, and the end
    return F.when(n < 2, start).otherwise(F.aggregate(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), start, step))


def _viterbi(n: Column, edges: Column) -> Column:
    """The mask of starts of the segmentation with the highest sum of scores; of equals, the longest last pieces."""
    zero = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("mask")))

    def step(state: Column, end: Column) -> Column:
        into = F.filter(edges, lambda e: e["s"] + e["l"] == end)
        ways = F.transform(
            into,
            lambda e: F.struct(
                (F.get(state, e["s"])["score"] - e["rank"]).alias("score"),
                (-e["s"]).alias("near"),
                F.get(state, e["s"])["mask"].bitwiseOR(_bit(end)).alias("mask"),
            ),
        )
        best = F.array_max(ways)
        return F.concat(state, F.array(F.struct(best["score"].alias("score"), best["mask"].alias("mask"))))

    return F.element_at(F.aggregate(F.sequence(F.lit(1), n), zero, step), -1)["mask"]


def segment(parts: DataFrame, pieces: Pieces) -> DataFrame:
    """(shard, key, ids) of parts (shard, key, word): the lattice and its fold.

    Every character has an edge: its own piece, or its bytes'. Words are strings with blanks as ``SPACE``.
    """
    spark = parts.sparkSession
    table = F.broadcast(spark.createDataFrame(pieces.rows, "sub string, id int, score double"))
    sized = parts.withColumn("n", F.char_length("word"))
    starts = sized.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    lengths = F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.col("n") - F.col("s")))
    spans = starts.withColumn("l", F.explode(lengths)).withColumn("sub", F.substring("word", F.col("s") + 1, F.col("l")))
    edges = spans.join(table, "sub", "left").where("id IS NOT NULL OR l = 1")
    # a character without a piece travels as its bytes, in one number below zero
    raw = -F.conv(F.hex(F.encode("sub", "UTF-8")), 16, 10).cast("long") - 1

    def ids(number: Column) -> Column:
        plain = -(number + 1)
        last = F.when(plain < 256, 0).when(plain < 65_536, 1).when(plain < 1 << 24, 2).otherwise(3)
        byte = lambda i: F.call_function("shiftright", plain, i * 8).bitwiseAND(255).cast("int") + pieces.first_byte
        return F.when(number >= 0, F.array(number.cast("int"))).otherwise(F.transform(F.sequence(last, F.lit(0), F.lit(-1)), byte))

    low, high = _bit(F.col("s")), _bit(F.col("s") + F.col("l"))
    worst = 1e10  # a character without a piece, where scores add up
    edge = F.struct(
        F.coalesce(-F.col("score"), F.lit(worst)).alias("rank"),
        "s",
        "l",
        low.bitwiseOR(high).alias("full"),
        (high - 1).bitwiseAND(F.bitwise_not(low * 2 - 1)).alias("inner"),
        F.coalesce(F.col("id").cast("long"), raw).alias("id"),
    )
    grouped = edges.groupBy("shard", "key", "n").agg(F.array_sort(F.collect_list(edge)).alias("edges"))
    fold = _viterbi if pieces.kind == UNIGRAM else _merged
    masked = grouped.withColumn("mask", fold(F.col("n"), F.col("edges")))
    mask = F.col("mask")
    chosen = F.filter(
        "edges", lambda e: (mask.bitwiseAND(e["full"]) == e["full"]) & (mask.bitwiseAND(e["inner"]) == 0)
    )
    placed = F.array_sort(F.transform(chosen, lambda e: F.struct(e["s"].alias("s"), e["id"].alias("id"))))
    return masked.select("shard", "key", F.flatten(F.transform(placed, lambda e: ids(e["id"]))).alias("ids"))


def _prepared(docs: DataFrame, text: str) -> Column:
    """The text as the model sees it: a blank in front, and the model's own mark for a blank is one."""
    plain = F.replace(docs[text], F.lit(SPACE), F.lit(" "))
    return F.when(F.char_length(docs[text]) > 0, F.concat(F.lit(" "), plain)).otherwise("")


def part_ids(texts: DataFrame, pieces: Pieces, cut: Cut) -> tuple[list[tuple[int, str]], int]:
    """The lookup table of the texts' distinct parts to their ids: its files and its shard bits."""
    spark: SparkSession = texts.sparkSession
    bits = vocabulary.shard_bits(texts, "text")
    parts = vocabulary.distinct_spans(texts, "text", cut, bits, most=HELD, chunk=CHUNK_BYTES)
    words = parts.where("word IS NOT NULL").select(
        "shard", "key", F.replace(F.col("word").cast("string"), F.lit(" "), F.lit(SPACE)).alias("word")
    )
    # edges are many times the parts, and are sorted by part: a task gets few
    partitions = max(FOLD_TASKS << bits, int(spark.conf.get("spark.sql.shuffle.partitions")))
    short = words.where(F.char_length("word") <= MOST_CHARACTERS).repartition(partitions, "shard", "key")
    ids = segment(short, pieces).repartitionById(1 << bits, F.col("shard"))

    def payload(batch: pa.RecordBatch) -> list[bytes | None]:
        column = batch.column("ids")
        offsets = (column.offsets.to_numpy() - column.offsets[0].as_py()) * 4
        data = column.flatten().to_numpy().astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]

    manifest = materialise(vocabulary.write_table(ids, scratch_path(spark, "parts"), payload), "parts")
    return [(r.shard, r.uri) for r in manifest.select("shard", "uri").collect()], bits


_LIBRARY: dict = {}


def _whole(path: str):
    """The library's ids of prepared texts, as bytes."""
    if path not in _LIBRARY:
        import sentencepiece

        _LIBRARY[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    found = _LIBRARY[path]
    return lambda texts: [np.array(found.encode(t[1:]), dtype="<u4").tobytes() for t in texts]


class Decoder:
    """Ids to bytes."""

    def __init__(self, pieces: Pieces):
        self.raw = np.frombuffer(b"".join(pieces.texts), np.uint8)
        self.length = np.array([len(t) for t in pieces.texts], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids' pieces; a text's first blank is the model's own."""
        return gather(self.raw, self.start[ids], self.length[ids])


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, decoded and, if asked for, ids) of every document, over its whole text.

    ``model`` is the path of a model file that every executor has. Null and empty texts have no pieces.
    ``decoded`` says that the ids decode to the text, with the model's mark for a blank read as a
    blank. Rows are taken as they come: repeated ones are encoded each.
    """
    pieces = read_pieces(model)
    cut, held = cut_parts(pieces), docs.sparkSession.sparkContext.broadcast(pieces)
    rows = docs.select(docs[key].cast("long").alias("doc_id"), _prepared(docs, text).alias("text"))
    files, bits = part_ids(rows, pieces, cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, decoder, whole = vocabulary.table(files, bits), Decoder(held.value), _whole(model)
        for batch in batches:
            own, first = batch.column("doc_id"), 0
            for ids, lengths, spans in token_files.encode_column(batch.column("text"), cut, parts, whole, None):
                ends = np.concatenate(([0], np.cumsum(lengths)))
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                back = decoder.decode(ids)
                edges = np.concatenate(([0], np.cumsum(decoder.length[ids])))[ends]
                same = [
                    np.array_equal(back[a:b], spans.raw[c:d])
                    for a, b, c, d in zip(edges[:-1], edges[1:], spans.offsets[:-1], spans.offsets[1:])
                ]
                columns = [own.slice(first, len(lengths)), pa.array(lengths), pa.array(sums, pa.int64()), pa.array(same)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))))
                first += len(lengths)
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded boolean" + (", ids array<int>" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]
    return rows.mapInArrow(storage.trimmed(run), schema)


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``text``: what its ids decode to. Null and empty lists decode to an empty text."""
    held = encoded.sparkSession.sparkContext.broadcast(read_pieces(model))

    @F.pandas_udf("string")
    def back(column):
        decoder = Decoder(held.value)
        found = [np.array([] if v is None else v, dtype=np.int64) for v in column]
        return column.__class__([decoder.decode(v).tobytes()[1:].decode(errors="replace") for v in found], dtype="object")

    return encoded.withColumn("text", back(F.col(ids)))
