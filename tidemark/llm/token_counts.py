"""Token counts by a whole-token shortcut.

Which vocabulary strings the model encodes alone as one token is proved beforehand, by encoding
each. A pre-token found among them counts one; only the others are merged, each distinct one once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe

#: The pre-tokens of the word model, for plain lower-case pieces.
PRE_TOKENS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{bpe.LETTERS}]+|[0-9]|[{bpe.PUNCTUATION}]+")


def whole_tokens(path: str, suffix: str = "</w>") -> frozenset[str]:
    """The vocabulary strings that, as texts of their own, encode as exactly their own id."""
    tokenizer = bpe.load(path)
    back = {c: b for b, c in bpe.byte_letters().items()}
    texts, ids = [], []
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(back[c] for c in token.removesuffix(suffix)).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if token.endswith(suffix) and text:
            texts.append(text)
            ids.append(i)
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(text for text, i, found in zip(texts, ids, encoded) if found.ids == [i])


class Counter:
    """Counts of texts; a blank always ends a pre-token, so the counts of the parts add up."""

    def __init__(self, path: str, singles: frozenset[str]):
        self.tokenizer, self.singles = bpe.load(path), singles
        self.model = self.tokenizer.model
        self.table = str.maketrans({chr(b): c for b, c in bpe.byte_letters().items()})
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces: dict[str, int] = {"": 0}
        self.tokens: dict[str, int] = {}

    def _token(self, token: str) -> int:
        if token in self.singles:
            return 1
        found = self.tokens.get(token)
        if found is None:
            found = len(self.model.tokenize(token.encode().decode("latin-1").translate(self.table)))
            self.tokens[token] = found
        return found

    def _piece(self, piece: str) -> int:
        if bpe.PLAIN.fullmatch(piece) and not any(s in piece for s in self.special):
            return sum(map(self._token, PRE_TOKENS.findall(piece.lower())))
        return len(self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0].ids)

    def count(self, texts: list[str]) -> list[int]:
        if len(self.pieces) + len(self.tokens) > bpe.CACHE_PIECES:
            self.pieces, self.tokens = {"": 0}, {}
        cut = [text.split(" ") for text in texts]
        pieces = self.pieces
        for piece in set(chain.from_iterable(cut)) - pieces.keys():
            pieces[piece] = self._piece(piece)
        return [sum([pieces[p] for p in parts]) for parts in cut]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", limit: int = 2048) -> DataFrame:
    """The ``keep`` columns with n_bytes, n_tokens and over_limit; null and empty texts have no tokens.

    ``tokenizer`` is the path of a JSON file that every executor has. The proved strings are at most
    the vocabulary, whatever the data.
    """
    singles = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer))
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].alias("text"))
    kept = rows.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = Counter(tokenizer, singles.value)
        counter = _COUNTERS[tokenizer]
        for batch in batches:
            sizes, counts = [], []
            for first in range(0, batch.num_rows, 512):
                texts = [t or "" for t in batch.column("text").slice(first, 512).to_pylist()]
                sizes += [len(t.encode()) for t in texts]
                counts += counter.count(texts)
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], [*names, "n_bytes", "n_tokens"]
            )

    counted = rows.mapInArrow(run, kept.schema.add("n_bytes", "long").add("n_tokens", "long"))
    renamed = [F.col(n).alias(c) for n, c in zip(names, keep)]
    return counted.select(*renamed, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
