"""A bigram language model in Elias-Fano tries, and the scores of whole texts.

The first level of the trie is the sorted vocabulary. Each shard of the vocabulary has a second-level
file with the successors of its words: pointers from contexts to ranges of successors, successors
relative to their context's place, and quantised smoothed log probabilities. Files are memory-mapped by the
scoring tasks; nothing of the model is collected or broadcast but the files' names.

Smoothing is interpolated absolute discounting down to the additive unigram of the training texts.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import elias_fano, storage, vocabulary
from tidemark.llm.words import NOT_SPACE, cut_words, distinct, spans_of
from tidemark.session import materialise, scratch_path

DISCOUNT = 0.75
ADDED = 0.1
#: Log probabilities are kept in steps of 1/4096, from 0 down to -16.
STEP = 4096.0
#: Pairs that a task holds before it merges and sends them.
HELD = 3_000_000
_CUT = cut_words(NOT_SPACE)


@dataclass
class Model:
    """Where the files are, and the corpus's totals. Numbers of words are ranks of their sorted keys."""

    words: list[tuple[int, str]]
    bits: int
    bases: np.ndarray  # first rank of each shard, and the number of all words
    tokens: int  # of training texts, with one end each
    documents: int
    pairs: list[tuple[int, str]]

    @property
    def end(self) -> int:
        return int(self.bases[-1])

    @property
    def begin(self) -> int:
        return self.end + 1

    def base(self, counts: np.ndarray) -> np.ndarray:
        """Additive unigram probabilities of tokens with these training counts."""
        distinct = self.end + (self.documents > 0)
        return (counts + ADDED) / (self.tokens + ADDED * (distinct + 1))

    def shard(self, ranks: np.ndarray) -> np.ndarray:
        """The shard of a context; the begin of a text belongs to the first."""
        found = np.searchsorted(self.bases, ranks, "right") - 1
        return np.where(ranks >= self.end, 0, found)


class _Vocabulary:
    """Ranks and counts of words."""

    def __init__(self, model: Model):
        self.model, self.table = model, vocabulary.table(model.words, model.bits)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ranks, training counts) of word keys; unknown words have the rank -1 and the count 0."""
        unique, inverse = distinct(keys)
        found, _, counts = self.table.find(unique, np.dtype("<i8"))
        count, rank = np.zeros(len(unique), np.int64), np.full(len(unique), -1, np.int64)
        count[found] = counts
        edges = np.searchsorted(unique >> np.uint64(64 - self.model.bits), np.arange((1 << self.model.bits) + 1, dtype=np.uint64))
        for shard in np.flatnonzero(np.diff(edges)).tolist():
            if shard in self.table.uris:
                a, b = edges[shard], edges[shard + 1]
                keys_ = self.table._shard(shard)[0]
                rank[a:b] = np.where(found[a:b], np.searchsorted(keys_, unique[a:b]) + self.model.bases[shard], -1)
        return rank[inverse], count[inverse]

    def counts(self, ranks: np.ndarray) -> np.ndarray:
        """Training counts of ranks; the end counts once a text."""
        out = np.where(ranks == self.model.end, self.model.documents, 0).astype(np.int64)
        shard = np.where(ranks < self.model.end, np.searchsorted(self.model.bases, ranks, "right") - 1, -1)
        for s in np.unique(shard[shard >= 0]).tolist():
            own = shard == s
            out[own] = self.table._shard(s)[2].view("<i8")[ranks[own] - self.model.bases[s]]
        return out


def _sequences(column: pa.Array, words: _Vocabulary) -> Iterator[tuple]:
    """(texts, context ranks, token ranks, token counts, number of tokens of each text) of chunks."""
    model = words.model
    for spans in spans_of(column, _CUT, lower=True):
        rank, count = words.find(spans.key)
        sizes = np.diff(spans.bounds())
        ends = np.cumsum(sizes)
        token = np.insert(rank, ends, model.end)
        counts = np.insert(count, ends, model.documents)
        context = np.insert(rank, ends - sizes, model.begin)
        yield spans.texts, context, token, counts, sizes + 1


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (context << 32 | token) with the sums of their counts."""
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    pair, count = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    heads = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.empty(0, np.int64)
    return pair[heads], np.add.reduceat(count[order], heads) if len(pair) else count


def _pack(pair: np.ndarray, count: np.ndarray) -> bytes:
    contexts = np.diff(pair >> np.uint64(32), prepend=np.uint64(0)).astype("<u4")
    plain = contexts.tobytes() + pair.astype("<u4").tobytes() + np.minimum(count, 0xFFFFFFFF).astype("<u4").tobytes()
    return struct.pack("<Q", len(pair)) + zstandard.ZstdCompressor(level=1).compress(plain)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    (n,) = struct.unpack_from("<Q", blob)
    plain = zstandard.ZstdDecompressor().decompress(blob[8:], max_output_size=12 * n)
    context = np.cumsum(np.frombuffer(plain, "<u4", n), dtype=np.uint64)
    return context << np.uint64(32) | np.frombuffer(plain, "<u4", n, 4 * n), np.frombuffer(plain, "<u4", n, 8 * n).astype(np.int64)


def _level(model: Model, pair: np.ndarray, count: np.ndarray, words: _Vocabulary) -> bytes:
    """A shard's second level."""
    context, token = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
    heads = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
    sizes = np.diff(np.append(heads, len(pair)))
    total = np.add.reduceat(count, heads)
    place = np.repeat(np.arange(len(heads)), sizes)
    universe = model.begin + 1
    back = DISCOUNT * sizes / total
    chance = (count - DISCOUNT) / total[place] + back[place] * model.base(words.counts(token))
    quantised = lambda p: np.clip(np.round(-np.log10(p) * STEP), 0, 65535).astype("<u2").tobytes()
    blocks = [
        elias_fano.encode(context[heads], universe),
        elias_fano.encode(np.append(heads, len(pair)), len(pair) + 1),
        elias_fano.encode(place * universe + token, len(heads) * universe),
        quantised(back),
        quantised(chance),
    ]
    return b"".join(blocks)


class _Level:
    def __init__(self, uri: str, model: Model):
        data = storage.mapped(uri)
        self.universe = model.begin + 1
        self.contexts = elias_fano.Sequence(data)
        self.pointers = elias_fano.Sequence(data, self.contexts.end)
        self.tokens = elias_fano.Sequence(data, self.pointers.end)
        self.back = np.frombuffer(data, "<u2", self.contexts.n, self.tokens.end)
        self.chance = np.frombuffer(data, "<u2", self.tokens.n, self.tokens.end + 2 * self.contexts.n)

    def score(self, context: np.ndarray, token: np.ndarray, base: np.ndarray) -> np.ndarray:
        """log10 of each token's probability after its context; unknown tokens have the rank -1."""
        place, known = self.contexts.successor(context)
        out = np.where(known, base - self.back[np.minimum(place, self.contexts.n - 1)] / STEP, base)
        where = np.flatnonzero(known & (token >= 0))
        at, hit = self.tokens.successor(place[where] * self.universe + token[where])
        out[where[hit]] = -(self.chance[at[hit]] / STEP)
        return out

    def successors(self, context: int) -> np.ndarray:
        """The tokens that follow a context, through its pointers."""
        place, known = self.contexts.successor(np.array([context]))
        if not known[0]:
            return np.empty(0, np.int64)
        start, stop = self.pointers.value(np.array([place[0], place[0] + 1])).astype(np.int64)
        return self.tokens.value(np.arange(start, stop)).astype(np.int64) - place[0] * self.universe


def learn(train: DataFrame, text: str = "text") -> Model:
    """The model of all texts of ``train``; null and empty texts are an end alone.

    Two passes: one for the vocabulary, one for the pairs. Counts cover every text, and nothing is pruned.
    """
    spark = train.sparkSession
    bits = vocabulary.shard_bits(train, text)
    texts = train.select(train[text].alias("text"))

    def counts(batch: pa.RecordBatch) -> list[bytes]:
        return [struct.pack("<q", n) for n in batch.column("n").to_pylist()]

    packed = vocabulary.packed_spans(texts, "text", _CUT, bits, lower=True)
    written = vocabulary.write_table(packed, scratch_path(spark, "words"), counts, vocabulary.merging(bits))
    manifest = materialise(written, "words").collect()  # one row a shard
    sizes = np.zeros(1 << bits, np.int64)
    for row in manifest:
        sizes[row.shard] = row.n
    bases = np.concatenate(([0], np.cumsum(sizes)))
    if bases[-1] >= 1 << 32:
        raise ValueError("more distinct words than ranks of 32 bits")
    documents = texts.count()
    total = documents + sum(row.total for row in manifest)
    model = Model([(r.shard, r.uri) for r in manifest], bits, bases, total, documents, [])
    pairs = materialise(_pairs(texts, model, scratch_path(spark, "pairs")), "pairs")
    model.pairs = [(r.shard, r.uri) for r in pairs.collect()]
    return model


def _pairs(texts: DataFrame, model: Model, folder: str) -> DataFrame:
    """(shard, uri) of the second-level files."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, held = _Vocabulary(model), [], 0

        def send() -> pa.RecordBatch:
            pair, count = _merged(parts)
            shard = model.shard((pair >> np.uint64(32)).astype(np.int64))
            order = np.argsort(shard, kind="stable")  # the begin of texts comes last, but belongs to the first shard
            pair, count, shard = pair[order], count[order], shard[order]
            own, edges = np.unique(shard, return_index=True)
            edges = np.append(edges, len(pair))
            blobs = [_pack(pair[a:b], count[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "data"])

        for batch in batches:
            for _, context, token, _, _ in _sequences(batch.column("text"), words):
                # a word that has no key of its own has no rank; its pairs are left to the unigram
                good = (context >= 0) & (token >= 0)
                pair, count = np.unique(context[good].astype(np.uint64) << np.uint64(32) | token[good].astype(np.uint64), return_counts=True)
                parts.append((pair, count))
                held += len(pair)
                if held > HELD:
                    yield send()
                    parts, held = [], 0
        if held:
            yield send()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, shard, held = [], None, 0
        for batch in batches:
            for own, blob in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist()):
                shard = own
                parts.append(_unpack(blob))
                held += len(parts[-1][0])
                if held > 2 * HELD:
                    parts = [_merged(parts)]
                    held = len(parts[0][0]) // 2
        if shard is None:
            return
        uri = storage.fresh(folder, ".level")
        with storage.create(uri) as file:
            file.write(_level(model, *_merged(parts), _Vocabulary(model)))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "uri": [uri]})

    packed = texts.mapInArrow(local, vocabulary.PACKED).repartitionById(1 << model.bits, F.col("shard"))
    return packed.mapInArrow(build, "shard int, uri string")


def add_scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``base_score`` is the unigram's and ``score`` the model's log10 probability of the whole text and its end.
    """
    rows = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, levels = _Vocabulary(model), {}
        uris = dict(model.pairs)
        for batch in batches:
            first = 0
            for texts, context, token, counts, sizes in _sequences(batch.column("text"), words):
                base = np.log10(model.base(counts))
                score, shard = base.copy(), np.where(context >= 0, model.shard(context), -1)
                order = np.argsort(shard, kind="stable")
                edges = np.searchsorted(shard[order], np.arange((1 << model.bits) + 1))
                for s in np.flatnonzero(np.diff(edges)).tolist():
                    if s in uris:
                        if s not in levels:
                            levels[s] = _Level(uris[s], model)
                        own = order[edges[s] : edges[s + 1]]
                        score[own] = levels[s].score(context[own], token[own], base[own])
                starts = np.cumsum(sizes) - sizes
                columns = [
                    batch.column("doc_id").slice(first, texts),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)),
                    pa.array(np.full(texts, model.tokens)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(score, starts)),
                ]
                first += texts
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = rows.drop("text").schema
    for name, kind in zip(names[1:], ["long", "long", "long", "double", "double"]):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema)


def held_out(key: str, divisor: int = 10) -> Column:
    """Whether a document is kept from training; one with a null key is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % divisor == 0, F.lit(False))
