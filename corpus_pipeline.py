"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, documents that
hold benchmark passages go, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Rows with null ids and
null, empty and very long texts pass through every stage by the operators' rules.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, near_dups, sentencepiece, toxicity
from tidemark.session import materialise
from tidemark.sources.tables import table

#: A document is rejected as toxic from this score on.
TOXIC = 0.3


def _kept(docs: DataFrame, judged: DataFrame, keep: str) -> DataFrame:
    """The columns of ``docs`` where ``keep`` holds of the one column that ``judged`` has more, ``verdict``.

    Columns go by place, so those of ``docs`` may have any names.
    """
    places = [f"c{i}" for i in range(len(docs.columns))]
    kept = judged.toDF(*places, "verdict").where(keep)
    return kept.select(*[F.col(p).alias(c) for p, c in zip(places, docs.columns)])


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below ``TOXIC``.

    The classifier learns from the labels of three quarters of the documents, by their ids.
    """
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = toxicity.train_model(docs, table(spark, sf_dir, "labels"), train)
    return _kept(docs, toxicity.add_scores(docs, model, docs.columns), f"verdict < {TOXIC}")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents with similarity 0.8 or more, the one with the smallest id."""
    return near_dups.keep_first(docs, least=0.8)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    found = decontaminate.find_windows(docs, table(spark, sf_dir, "benchmark"), docs.columns, width=10)
    return _kept(docs, found, "size(verdict.hit_words) = 0")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text's pieces, and whether they decode to the text."""
    return sentencepiece.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("sentencepiece", encode),
]

#: The stages' results are not expressible in SQL; they are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
