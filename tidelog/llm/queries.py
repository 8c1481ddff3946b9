"""The queries of this subpackage: each operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import (
    content_sort, fingerprints, hard_negatives, jaccard, language_id, licenses, mixing, packing, passage_quality, sharding,
    toxicity, url_rules, whitening,
)
from tidelog.plans.tables import table

Query = Callable[[SparkSession, str], DataFrame]

# (host, path, verdict)
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))


def fold(folds: int) -> Column:
    """Which of so many folds a document is in; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), fold(5) != 0)
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.mark_copies(table(spark, sf_dir, "documents"), largest=True)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return licenses.scan(documents, licenses.fit(documents))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents, fold(3) != 1)
    predicted = language_id.predict(documents, model)
    return predicted.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


def edited_end(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the next."""
    end = len(text) // 4
    return text[: len(text) - end] + following[:end]


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.compare_with_next(table(spark, sf_dir, "documents"), edited_end)
    return compared.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return whitening.whiten(embeddings, whitening.fit(embeddings))


def op12_quality_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = passage_quality.fit(documents, table(spark, sf_dir, "labels"), fold(4) != 2)
    scored = passage_quality.score(documents, model)
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    embeddings = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(embeddings, F.col("vec_id") % 100 == 0)


def registered() -> dict[str, Query]:
    operators = {name: item for name, item in globals().items() if name.startswith("op")}
    return operators | {"pipeline": corpus_pipeline.run}


def statements() -> dict[str, str]:
    from tidelog.llm.oracles import SQL

    return dict(SQL)
