from __future__ import annotations

import pytest
from oracle import SF_DIR

#: Texts that operators stumble over: none, empty, blank, very long, odd white space, special strings, other scripts.
ODD_TEXTS = [
    None,
    "",
    " ",
    "  two  blanks  ",
    "a\n \nb \n c",
    "x <|endoftext|> y<|endoftext|>z",
    "A\n <|startoftext|> B",
    "it's we'll 'S can't 's 'x ''s",
    "Ünïcödé ÀÉÎ ßtraße İstanbul ΣΑΣ",
    "日本語 テキスト 中文",
    "é combining, nbsp between, ideographic　space, \u0085next",
    "emoji 👩‍👩‍👧 and 1234567 and 12 34",
    "tab\tand\rreturn\x0bvt\x0cff\x1cfs",
    "!!! ??? ...,,, --- a.b,c;d",
    "word " * 20_000,
    "q" * 5_000,
    "same text twice",
    "same text twice",
    "\n\nstarts\n\n\nwith lines\n",
]


@pytest.fixture(scope="session")
def odd(spark):
    """(doc_id, text) and columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(ODD_TEXTS)] + [(None, "a null id", "x", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, key int, found int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
