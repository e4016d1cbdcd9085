"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of ordinary text and one that also holds what
marks toxic text. Each window of a text is compressed with both; where the toxic one makes it
shorter, by more than calibrated amounts, the text is likely to be toxic.

Ordinary words fill toxic texts too. The toxic dictionary is therefore the ordinary one and,
appended, the words that occur in significantly more different contexts of toxic than of ordinary
training texts: both share their entropy tables and ordinary content, and a difference in length
comes from toxic words alone. Contexts are counted, not occurrences, so that copies of a text add
nothing.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import storage
from tidemark.llm.words import normal_words

#: Words of a window; windows start at every half of one, so each word lies in two.
WINDOW_WORDS = 8
DICTIONARY_BYTES = 1 << 15
#: Marking words of the toxic dictionary, and windows that the ordinary one is trained on, at most.
MOST_MARKS, MOST_WINDOWS = 2_048, 100_000
LEVEL = 3
#: Likelihood-ratio statistic and ratio of rates from which a word marks toxic text.
LEAST_EVIDENCE, LEAST_RATIO = 20.0, 3.0
#: Bytes of word beginnings that are counted beside whole words: inflected words share them.
STEM_BYTES = 4
#: Bytes of the codes of a word's beginning and of the word.
STEM_CODE, WORD_CODE = 3, 4
#: Bytes that both windows around a word must win together to count as a hit.
HIT = 10
#: Words that a worker process remembers widened at a time.
CACHE_WORDS = 100_000


@dataclass
class Model:
    """The dictionaries (None if a class has no examples), and a logistic calibration of the gains."""

    ordinary: bytes | None = None
    toxic: bytes | None = None
    centre: np.ndarray = field(default_factory=lambda: np.zeros(5))
    spread: np.ndarray = field(default_factory=lambda: np.ones(5))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(6))
    share: float = 0.0


def _code(data: bytes, size: int) -> bytes:
    return (zlib.crc32(data) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big")[:size]


def widened_stem(stem: bytes) -> bytes:
    return b" " + _code(stem, STEM_CODE) + stem


class _Widened(dict):
    """Words to their widened forms."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        wide = b" " + _code(word[:STEM_BYTES], STEM_CODE) + word + _code(word + b"$", WORD_CODE)
        self[word] = wide
        return wide


def half_windows(text: bytes, wide: _Widened) -> list[bytes]:
    words, half = [wide[word] for word in normal_words(text)], WINDOW_WORDS // 2
    return [b"".join(words[i : i + half]) for i in range(0, len(words), half)]


def _compressor(dictionary: bytes):
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_FULLDICT)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
    ).compress


class Scorer:
    """Scores of texts; one per worker process."""

    def __init__(self, model: Model):
        self.model, self.wide = model, _Widened()
        if model.ordinary:
            self.plain, self.marked = _compressor(model.ordinary), _compressor(model.toxic)

    def gains(self, text: bytes) -> np.ndarray:
        """Per half window, the bytes that the toxic dictionary saves on the two windows that hold it."""
        halves = half_windows(text, self.wide)
        padded = [b"", *halves, b""]
        windows = [a + b for a, b in zip(padded, padded[1:])]
        plain, marked = self.plain, self.marked
        saved = np.array([len(plain(w)) - len(marked(w)) for w in windows], dtype=np.int64)
        return saved[:-1] + saved[1:] if halves else np.zeros(0, dtype=np.int64)

    def features(self, text: bytes) -> list[float]:
        gains = np.sort(self.gains(text))[::-1]
        top = np.zeros(3)
        top[: min(3, len(gains))] = gains[:3]
        return [*top, float((gains >= HIT).sum()), math.log1p(len(gains))]

    def score(self, text: bytes) -> float:
        if not self.model.ordinary:
            return self.model.share
        x = (np.array(self.features(text)) - self.model.centre) / self.model.spread
        z = float(self.model.weights[0] + x @ self.model.weights[1:])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _contexts(texts: list[bytes]) -> Counter:
    """How many different words stand before each (word, True), and before words with each (beginning, False)."""
    seen = set()
    for text in texts:
        words = normal_words(text)
        seen.update(zip([b"", *words], words))
    found = Counter((word, True) for _, word in seen)
    found.update((word[:STEM_BYTES], False) for _, word in seen if len(word) > STEM_BYTES)
    return found


def marking_words(toxic: list[bytes], ordinary: list[bytes]) -> list[tuple[bytes, bool]]:
    """(word, True) and (beginning, False) with significantly more contexts in toxic texts, strongest last."""
    a, b = _contexts(toxic), _contexts(ordinary)
    na, nb = (max(1, sum(n for (_, whole), n in c.items() if whole)) for c in (a, b))
    found = []
    for mark, n in a.items():
        m = b[mark]
        if n / na <= LEAST_RATIO * m / nb:
            continue
        share = (n + m) / (na + nb)
        evidence = 2 * (n * math.log(n / (na * share)) + (m * math.log(m / (nb * share)) if m else 0.0))
        if evidence > LEAST_EVIDENCE:
            found.append((evidence, mark))
    return [mark for _, mark in sorted(found)][-MOST_MARKS:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    centre, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 0.1)
    z = np.column_stack([np.ones(len(x)), (x - centre) / spread])
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, z.T @ (p - y) + 1e-2 * w)
    return centre, spread, w


def fit(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    """Dictionaries from three quarters of the texts, calibration on the others."""
    share = len(toxic) / max(1, len(toxic) + len(ordinary))
    learn = [[t for i, t in enumerate(texts) if i % 4] for texts in (toxic, ordinary)]
    marks = marking_words(*learn) if all(learn) else []
    if not marks:
        return Model(share=share)
    wide = _Widened()
    halves = [half for text in learn[1] for half in half_windows(text, wide)]
    try:
        windows = [a + b for a, b in zip(halves[::2], halves[1::2])]
        # every n-th window, so that all texts of the sample have their share
        plain = zstandard.train_dictionary(DICTIONARY_BYTES, windows[:: -(-len(windows) // MOST_WINDOWS) or 1]).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return Model(share=share)
    # what stands last in a dictionary is nearest to the text, and thus cheapest to refer to
    added = b"".join(wide[mark] if whole else widened_stem(mark) for mark, whole in marks)
    model = Model(plain, plain + added, share=share)
    scorer, rows, labels = Scorer(model), [], []
    for label, texts in ((1.0, toxic[::4]), (0.0, ordinary[::4])):
        rows += [scorer.features(text) for text in texts]
        labels += [label] * len(texts)
    model.centre, model.spread, model.weights = _logistic(np.array(rows), np.array(labels))
    return model


def training_texts(
    docs: DataFrame, labels: DataFrame, train: Column, most_toxic: int, most_ordinary: int, most_bytes: int
) -> tuple[list[bytes], list[bytes]]:
    """Texts of a bounded sample: the labelled ids with the smallest hashes that ``train`` admits.

    A label row counts once however often it is stored, and so does a document: of its texts of at most ``most_bytes``,
    the smallest is taken. The result is sorted, so the model does not depend on the order of rows.
    """
    order = F.xxhash64(F.col("doc_id"))
    known = labels.where(train & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct()
    parts = []
    for label, most in ((1, most_toxic), (0, most_ordinary)):
        own = known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(most)
        parts.append(own.select("doc_id", F.lit(label).alias("label")))
    ids = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= most_bytes)
    rows = texts.join(ids, "doc_id").groupBy("label", "doc_id").agg(F.min("text").alias("text"))  # no more rows than ids
    found = rows.orderBy("label", F.xxhash64("doc_id"), "doc_id").select("label", "text").collect()
    return [r.text.encode() for r in found if r.label == 1], [r.text.encode() for r in found if r.label == 0]


def train_model(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    most_toxic: int = 1_200,
    most_ordinary: int = 3_600,
    most_bytes: int = 50_000,
) -> Model:
    """A model of the labelled documents that ``train`` (over ``labels``) admits.

    The sample is bounded by the three parameters, so at most 240 MB of text and 17 MB as a rule reach
    the driver, whatever the data. From it, at most ``MOST_MARKS`` words and ``MOST_WINDOWS`` windows, dealt evenly over the
    texts, make the dictionaries. Repeated rows and labels teach what one does; null labels and ids teach nothing. Without examples of both
    classes, or without words that tell them apart, every score is the toxic share of the sample.
    """
    return fit(*training_texts(docs, labels, train, most_toxic, most_ordinary, most_bytes))


def add_scores(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``score``, 0 to 1, from the whole text alone; null is an empty text.

    Repeated rows are scored each, and very long texts whole. Columns that are not kept are not read, and kept ones may have
    any names; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            scores = [scorer.score(body) for body in storage.strings(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores, pa.float64())], [*names, "score"]
            )

    scored = rows.mapInArrow(storage.trimmed(run), rows.drop("_text").schema.add("score", "double"))
    return scored.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "score")
