"""Byte-level BPE of the tokenizers library, with each distinct span of a corpus encoded once.

A text is cut at its blanks. Where a blank is followed by anything but white space, the library's
pre-tokeniser always starts a new pre-token at the blank, so that the ids of the parts are the ids
of the text. A text with a part for which this is not so goes through the library as a whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tidemark.llm.words import byte_table

#: Distinct strings that a worker process remembers at a time.
CACHE_PIECES = 200_000

#: Characters whose classes do not depend on any library's Unicode tables.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PUNCTUATION = r"!-/:-@\[-`{-~"
PLAIN = re.compile(rf"[{LETTERS}0-9{PUNCTUATION}\n]*")
#: The pre-tokens of byte-level BPE, for plain pieces.
PRE_TOKENS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[{PUNCTUATION}]+|\n")


def load(path: str):
    """The tokenizer of a JSON file, on one thread: Spark's tasks are the threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level models write for each byte.

    Printable Latin-1 bytes stand for themselves, the others take the characters from 256 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTER, _DIGIT, _MARK, _LINE, _BLANK, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[0x21:0x7F] = _MARK
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_CLASS[0x0A], _CLASS[0x20] = _LINE, _BLANK
#: Bytes that keep a piece whole: apostrophes, as contractions have rules of their own, and "<", with
#: which special tokens may begin.
_WHOLE = byte_table([0x27, 0x3C]) | (_CLASS == _OTHER)


def cut_units(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that cover the texts and whose ids, one after the other, are the ids of the texts.

    A span begins at each blank and belongs to it. Pieces of plain characters are also cut into
    their pre-tokens; other pieces stay whole.
    """
    size = len(raw)
    if not size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = _CLASS[raw]
    edge = raw == 0x20
    edge[offsets[:-1][offsets[:-1] < size]] = True
    inner = np.zeros(size, dtype=bool)
    inner[1:] = ((kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK)) | (kind[1:] == _LINE)
    bad = _WHOLE[raw]
    line = np.flatnonzero(kind == _LINE)
    line = line[line > 0]
    bad[line[(kind[line - 1] == _LINE) | (kind[line - 1] == _BLANK)]] = True
    high = np.flatnonzero(raw >= 0x80)
    if len(high):
        own, before = raw[high], np.where(high > 0, raw[high - 1], 0)
        after = raw[np.minimum(high + 1, size - 1)]
        lead = (own == 0xC3) & (after >= 0x80) & (after < 0xC0)
        bad[high[~(lead | ((before == 0xC3) & (own < 0xC0) & (own != 0x97) & (own != 0xB7)))]] = True
    pieces = np.flatnonzero(edge)
    spoilt = np.zeros(len(pieces), dtype=bool)
    spoilt[np.searchsorted(pieces, np.flatnonzero(bad), "right") - 1] = True
    start = np.flatnonzero(edge | inner)
    first = edge[start]
    start = start[first | ~spoilt[np.cumsum(first) - 1]]
    return start, np.append(start[1:], size)


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.table = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokens: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _token(self, token: str) -> bytes:
        found = self.tokens.get(token)
        if found is None:
            letters = token.encode().decode("latin-1").translate(self.table)
            found = np.array([t.id for t in self.model.tokenize(letters)], dtype="<u4").tobytes()
            self.tokens[token] = found
        return found

    def unit(self, unit: str) -> bytes | None:
        """Ids of one of ``cut_units``' spans; None if they depend on what stands beside it."""
        piece = unit[1:] if unit[:1] == " " else unit
        if unit[:1] == " " and (not piece or piece[0].isspace()) or any(s in piece for s in self.special):
            return None
        if PLAIN.fullmatch(piece) and "\n\n" not in piece:
            if len(self.tokens) > CACHE_PIECES:
                self.tokens = {}
            return b"".join(map(self._token, PRE_TOKENS.findall(unit)))
        return self.whole([unit])[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process's encoder of a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
