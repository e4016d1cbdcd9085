from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as library
from pyspark.sql import functions as F

from tidemark.llm import sentencepiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_ids_are_the_librarys_and_decode(request, which):
    docs = request.getfixturevalue(which)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    processor = library.SentencePieceProcessor(model_file=MODEL)
    encoded = sentencepiece.encode(docs, MODEL, with_ids=True)
    rows = sentencepiece.decode(encoded, MODEL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        want = processor.encode(text)
        assert r.ids == want, text[:80]
        assert (r.n_pieces, r.ids_crc32) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        assert r.decoded and r.text == text


def test_marks_of_blanks_in_texts_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a▁b ▁"), (None, "x")], "doc_id long, text string")
    processor = library.SentencePieceProcessor(model_file=MODEL)
    rows = {r.doc_id: r for r in sentencepiece.encode(docs, MODEL, with_ids=True).collect()}
    assert rows[1].ids == processor.encode("a▁b ▁") and rows[1].decoded and rows[None].n_pieces == 1
    assert sentencepiece.encode(docs.where("false"), MODEL).count() == 0


def test_viterbi_against_all_segmentations(spark):
    rng = random.Random(4)
    table = ["a", "b", "c", "ab", "bc", "abc", "ca", "cab", "bb"]
    rows = [(p, i, -rng.uniform(1, 9)) for i, p in enumerate(table)]
    pieces = sentencepiece.Pieces(sentencepiece.UNIGRAM, rows, 300, [])
    words = ["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(60)]
    parts = spark.createDataFrame([(0, i, w) for i, w in enumerate(words)], "shard int, key long, word string")
    got = {r.key: r.ids for r in sentencepiece.segment(parts, pieces).collect()}
    score = {p: s for p, _, s in rows}
    for i, word in enumerate(words):
        best = -1e9
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            at = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(word)]
            best = max(best, sum(score.get(word[a:b], -1e9) for a, b in zip(at, at[1:])))
        found = [table[k] for k in got[i]]
        assert "".join(found) == word and sum(score[p] for p in found) == pytest.approx(best)


def test_main_path_has_no_python_in_the_lattice(spark):
    pieces = sentencepiece.read_pieces(MODEL)
    parts = spark.createDataFrame([(0, 1, "▁word")], "shard int, key long, word string")
    plan = sentencepiece.segment(parts.select("shard", F.col("key"), "word"), pieces)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan.split("Physical Plan")[1]
