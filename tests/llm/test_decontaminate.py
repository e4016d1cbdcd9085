from __future__ import annotations

import re

from oracle import SF_DIR

from tidemark.llm import decontaminate


def brute(text, items, width=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item_id, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        n = min(width, len(own))
        for window in {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit |= set(range(i, i + n))
                    found.add(str(item_id))
    return len(words), sorted(hit), sorted(found)


def test_odd_texts_and_items(spark, odd):
    items = [(1, "same text TWICE"), (2, None), (3, "…!"), (4, "word " * 12), (5, "Straße"), (6, "same text"), (6, "text twice"), (None, "tab and")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.found for r in decontaminate.find_windows(odd, benchmark, ["doc_id", "found"][:1]).collect()}
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert got.keys() == texts.keys()
    for i, found in got.items():
        if len(texts[i] or "") < 10_000:
            assert (found.n_words, found.hit_words, found["items"]) == brute(texts[i], items)
        for a, b in ((s.start, s.end) for s in found.spans):
            assert texts[i][a:b].strip() == texts[i][a:b] != ""
    assert got[14].n_words == len(got[14].hit_words) == 20_000


def test_blocks_give_the_same(spark, documents):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    whole = decontaminate.find_windows(documents, benchmark, ["doc_id"])
    blocks = decontaminate.find_windows(documents, benchmark, ["doc_id"], block_bytes=2_000)
    key = lambda r: r.doc_id
    assert sorted(whole.collect(), key=key) == sorted(blocks.collect(), key=key)
    assert whole.where("size(found.items) > 0").count() > 0


def test_no_items_no_documents(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_windows(documents, none, ["doc_id"]).where("size(found.hit_words) > 0").count() == 0
    assert decontaminate.find_windows(documents.where("false"), none, ["doc_id"]).count() == 0


def test_spans_do_not_depend_on_blocks(spark):
    """Windows that overlap in a document lie in different blocks."""
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(words[i : i + 4])) for i in range(0, 30, 2)] * 3 + [(None, "zz yy")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "A " + " ".join(words) + " end"), (1, "A " + " ".join(words) + " end"), (2, "no hit"), (3, None), (None, "x zz, YY!")]
    docs = spark.createDataFrame([(*r, "t", 5) for r in rows], "doc_id long, text string, _text string, _row int")
    one = decontaminate.find_windows(docs, benchmark, docs.columns)
    assert len(decontaminate.item_blocks(benchmark, "item_id", "text", 10)) > 5
    many = decontaminate.find_windows(docs, benchmark, docs.columns, block_bytes=10)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    found = {r.doc_id: r.found for r in one.collect()}
    assert [(s.start, s.end) for s in found[1].spans] == [(2, 2 + len(" ".join(words[:32])))]
    assert [(s.start, s.end) for s in found[None].spans] == [(2, 8)] and found[None]["items"] == ["None"]
