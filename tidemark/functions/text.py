"""Tokenisers, name rules and label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns of the word counts
WORD_PATTERN = r"([a-zA-Z]+('[a-z])?)"
NON_WORD_PATTERN = r"\W+"
WHITESPACE_PATTERN = r"\s"

# Candidate-source name rules
LANGUAGE_PREFIXES = ("sharecone-weighted-", "sharecone-weightedlag-")
LATEST_VIEW = "latestMinView"

# Spellings a strict boolean accepts
TRUE_SPELLINGS = ("1", "t", "T", "TRUE", "true", "True")
FALSE_SPELLINGS = ("0", "f", "F", "FALSE", "false", "False")


def words(line: Column) -> Column:
    """Letter runs with an optional 's-like ending, lower-cased."""
    return F.transform(F.regexp_extract_all(line, F.lit(WORD_PATTERN), F.lit(1)), F.lower)


def space_tokens(text: Column, keep_trailing_empty: bool = True) -> Column:
    """Split at every single space. Without ``keep_trailing_empty`` the empty tokens at the end go."""
    if keep_trailing_empty:
        return F.split(text, " ")
    cut = F.rtrim(text)
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(cut == "", F.array().cast("array<string>"))
        .otherwise(F.split(cut, " "))
    )


def csv_field(line: Column, index: int) -> Column:
    """Field ``index`` of a plain comma-separated line; a shorter line raises."""
    return F.element_at(F.split(line, ","), index + 1)


def non_word_tokens(line: Column) -> Column:
    """Split at runs of non-word characters, then lower-case; empty edge tokens stay."""
    return F.transform(F.split(line, NON_WORD_PATTERN), F.lower)


def whitespace_tokens(line: Column) -> Column:
    """Split at every whitespace character, case kept."""
    return F.split(line, WHITESPACE_PATTERN)


def simplify_source(name: Column, merge_latest_view: bool = True) -> Column:
    """Drop the language segment after a known prefix; optionally fold all latest-view sources into one."""
    out = F.when(F.lit(False), name)
    for prefix in LANGUAGE_PREFIXES:
        out = out.when(name.startswith(prefix), F.regexp_replace(name, f"^({prefix})[^-]*-?", "$1"))
    if merge_latest_view:
        out = out.when(name.contains(LATEST_VIEW), F.lit(LATEST_VIEW))
    return out.otherwise(name)


def strict_bool(text: Column) -> Column:
    """Only the fixed spellings pass; anything else, null included, raises."""
    return (
        F.when(text.isin(*TRUE_SPELLINGS), F.lit(True))
        .when(text.isin(*FALSE_SPELLINGS), F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(text, F.lit("null")))).cast("boolean"))
    )


def vote_label(text: Column) -> Column:
    """``(3, 2)``: at least 3 votes for gives 1, at most 1 gives 0, else 2 (undecided)."""
    votes = F.regexp_extract(text, r"\((\d+)", 1).cast("int")
    return F.when(votes >= 3, 1).when(votes <= 1, 0).otherwise(2)


def grade_label(text: Column) -> Column:
    """Grade 4 and up gives 1, 2 and below gives 0, else 2 (undecided)."""
    grade = text.cast("int")
    return F.when(grade >= 4, 1).when(grade <= 2, 0).otherwise(2)


def truth_label(text: Column) -> Column:
    """``true`` gives 1, ``false`` gives 0, anything else 2 (to be dropped)."""
    return F.when(text == "true", 1).when(text == "false", 0).otherwise(2)
