"""Id sequences held as space-joined text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAD = "0"  # fixed value: stands for an empty token and fills short sequences


def sequence_tokens(text: Column, length: int, keep: str = "oldest") -> Column:
    """Tokens between spaces, empty ones as ``0``, cut to ``length`` from the old or the new end."""
    tokens = F.transform(F.split(text, " "), lambda t: F.when(t == "", PAD).otherwise(t))
    if keep == "oldest":
        return F.slice(tokens, 1, length)
    if keep == "newest":
        return F.slice(tokens, F.greatest(F.size(tokens) - length, F.lit(0)) + 1, F.lit(length))
    raise ValueError(f"keep must be oldest or newest, not {keep}")


def pad(tokens: Column, length: int, filler: Column) -> Column:
    """``tokens`` filled up to ``length`` on the right."""
    return F.concat(tokens, F.array_repeat(filler, F.lit(length) - F.size(tokens)))


def padded_sequence(text: Column, length: int, keep: str = "oldest") -> Column:
    return pad(sequence_tokens(text, length, keep), length, F.lit(PAD))
