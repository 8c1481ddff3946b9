"""The pipeline from raw documents to packed training sequences.

Each stage works on all documents its predecessor kept. All but the last return the columns of
documents, whatever else these are called; the last returns the pieces of the documents and their places in sequences.

In every stage a null text is an empty one and texts are read whole, however long. An empty table goes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import content_sort, jaccard, mixing, packing, toxicity
from tidelog.llm.common import removed, stored_at
from tidelog.plans.tables import table
from tidelog.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labels of these documents, does not reject.

    Rows that repeat an id are judged one by one. Without labels of both classes nothing is rejected.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id; one without an id only where no other has the text.

    Of rows that repeat that id and text any one stays.
    """
    return content_sort.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: five words, a likeness of 0.8.

    Texts without a word are like no other and all stay; so does a row without an id unless it is like another.
    """
    return jaccard.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources want them; a null source is a source of its own.

    Rows that repeat an id are taken equally often. Documents without a word weigh nothing and are as often taken as others.
    """
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens; an empty text is one token, its end.

    Rows that repeat an id are packed one by one.
    """
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

ORACLE_SQL = None  # a trained classifier and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's table goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        docs = stored_at(stage(spark, docs, sf_dir), path)
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
