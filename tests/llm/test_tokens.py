"""Token files and token counts against the library itself."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import bpe, rans, token_counts, token_files
from tidemark.session import materialise, scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def expected_ids(path, texts):
    return [x.ids for x in bpe.load(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def written(spark, docs):
    files = token_files.write_ids(docs, scratch_path(spark, "ids"), BYTE, partition_bytes=20_000)
    return token_files.read_ids(materialise(files, "ids"))


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_files_hold_the_librarys_ids_in_key_order(spark, request, which):
    docs = request.getfixturevalue(which)
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    got = {r.key: r for r in written(spark, docs).collect()}
    assert len(got) == len(rows)
    start = 0
    for row, ids in zip(rows, expected_ids(BYTE, [r.text for r in rows])):
        found = got[row.doc_id]
        assert (found.start, found.n_tokens, found.ids) == (start, len(ids) + 1, [*ids, 0])
        assert found.ids_crc32 == zlib.crc32(np.array([*ids, 0], dtype="<u4").tobytes())
        start += len(ids) + 1


def test_repeated_keys_and_no_rows(spark):
    twice = spark.createDataFrame([(1, "b"), (1, "b"), (1, None)], "doc_id long, text string")
    assert sorted(r.start for r in written(spark, twice).collect()) in ([0, 1, 3], [0, 2, 4])
    assert written(spark, twice.where("false")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 31, 33, rans.BLOCK, rans.BLOCK + 1, 3 * rans.BLOCK - 5])
def test_segments_decode_whole_and_by_block(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50_257).astype(np.uint32)
    data = rans.encode(ids)
    assert np.array_equal(rans.decode(data), ids)
    assert np.array_equal(rans.decode(data, 1, 2), ids[rans.BLOCK : 2 * rans.BLOCK])
    if n > rans.BLOCK:
        assert len(data) < 4 * n / 2
        damaged = bytearray(data)
        damaged[len(data) // 2] ^= 1  # in the streams of whole blocks
        with pytest.raises(ValueError):
            rans.decode(bytes(damaged))


def test_one_symbol_and_the_largest_ids():
    for ids in (np.full(70_000, 9, np.uint32), np.array([(1 << 24) - 1, 0], np.uint32)):
        assert np.array_equal(rans.decode(rans.encode(ids)), ids)
    with pytest.raises(ValueError):
        rans.encode(np.array([1 << 24], np.uint32))


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_counts_are_the_librarys(request, which):
    docs = request.getfixturevalue(which)
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    want = dict(zip(rows, map(len, expected_ids(WORD, rows.values()))))
    got = token_counts.count_tokens(docs, WORD, ["doc_id"]).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.n_bytes == len((rows[r.doc_id] or "").encode()) and r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts.count_tokens(docs.where("false"), WORD, ["doc_id"]).count() == 0


def test_whole_tokens_are_proved():
    tokenizer, singles = bpe.load(WORD), token_counts.whole_tokens(WORD)
    assert "the" in singles and len(singles) > 20_000
    assert all(len(x.ids) == 1 for x in tokenizer.encode_batch(sorted(singles)[::50], add_special_tokens=False))


def test_plain_character_classes_agree_with_the_library():
    """Every plain character between letters, digits and marks is cut as the library cuts it."""
    pre = bpe.load(BYTE).pre_tokenizer
    back = {c: b for b, c in bpe.byte_letters().items()}
    for code in [*range(0x21, 0x7F), *range(0xC0, 0x100)]:
        text = f" a{chr(code)}b1{chr(code)}. {chr(code)}{chr(code)}"
        for piece in text.split(" ")[1:]:
            if bpe.PLAIN.fullmatch(piece):
                library = [bytes(back[c] for c in t).decode() for t, _ in pre.pre_tokenize_str(" " + piece)]
                assert bpe.PRE_TOKENS.findall(" " + piece) == library
