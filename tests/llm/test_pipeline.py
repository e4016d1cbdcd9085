"""Every stage against a plain recomputation on what its predecessor kept."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
import sentencepiece as library
from oracle import SF_DIR
from test_near_dups import brute_classes

import corpus_pipeline
from tidemark.session import materialise


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(materialise(stage(spark, found[-1], SF_DIR), name))
    return found


def contaminated(text, items):
    line = " " + " ".join(words_of(text)) + " "
    for _, item in items:
        own = words_of(item)
        n = min(10, len(own))
        if n and any(" " + " ".join(own[i : i + n]) + " " in line for i in range(len(own) - n + 1)):
            return True
    return False


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "sentencepiece"]
    assert all(df.columns == results[0].columns for df in results[:-1])


def test_toxic_documents_go(spark, results):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before, after = texts(results[0]), texts(results[1])
    assert all(before[i] == t for i, t in after.items())
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) > 0.95 * len(clean)
    assert len(after) < len(before)


def test_one_of_each_class_stays(results):
    before, after = texts(results[1]), texts(results[2])
    assert set(after) == set(brute_classes(list(before.items())).values())


def test_contaminated_documents_go(spark, results):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = texts(results[2]), texts(results[3])
    hit = {i for i, t in before.items() if contaminated(t, items)}
    assert hit and set(after) == set(before) - hit


def test_the_rest_is_encoded(results):
    before, after = texts(results[3]), {r.doc_id: r for r in results[4].collect()}
    processor = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert after.keys() == before.keys()
    assert all(r.ids == processor.encode(before[i]) and r.decoded for i, r in after.items())


def test_odd_rows_pass_every_stage(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, docs, SF_DIR), name)
        assert kept.columns == odd.columns and kept.count() > 0
        assert stage(spark, docs.where("false"), SF_DIR).count() == 0
        docs = kept
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, SF_DIR).count() == docs.count()
