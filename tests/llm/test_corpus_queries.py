"""The registered corpus queries: against their SQL, or against brute force, over whole tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from compare import difference, tables_of
from test_documents import brute_groups, check_packed, edit
from tidelog.llm import fingerprints, jaccard, mixing
from tidelog.llm import queries as plans

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(plans.statements()))
def test_query_matches_sql(spark, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(got, tables_of(SF_DIR).execute(entry.oracle_sql()[name]).df()) is None


def token_ids(rows):
    tokens = Tokenizer.from_file(corpus_pipeline_tokenizer())
    return [(row["doc_id"], tokens.encode(row["text"] or "", add_special_tokens=False).ids + [0]) for row in rows]


def corpus_pipeline_tokenizer():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def test_packing(spark, documents):
    rows = entry.queries()["op1_pack_documents"](spark, SF_DIR).collect()
    sequences = check_packed(rows, token_ids(documents))
    least = -(-sum(row["length"] for row in rows) // 2048)
    assert sequences <= 1.02 * least + 2


def test_held_out_folds(spark, documents):
    toxic = {row["doc_id"]: row for row in entry.queries()["op2_toxicity"](spark, SF_DIR).collect()}
    languages = {row["doc_id"]: row for row in entry.queries()["op7_language_id"](spark, SF_DIR).collect()}
    assert len(toxic) == len(languages) == len(documents)
    for row in documents:
        check = zlib.crc32(str(row["doc_id"]).encode())
        assert toxic[row["doc_id"]]["held_out"] == (check % 5 == 0)
        assert languages[row["doc_id"]]["held_out"] == (check % 3 == 1)
    held = [row for row in documents if languages[row["doc_id"]]["held_out"]]
    assert sum(languages[row["doc_id"]]["lang_pred"] == row["lang"] for row in held) >= 0.97 * len(held)


def test_toxicity_of_held_out_documents(spark):
    larger = "/root/testdata/sf0.1"
    labels = {row["doc_id"]: row["toxic"] for row in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    rows = [row for row in entry.queries()["op2_toxicity"](spark, larger).collect() if row["held_out"] and row["doc_id"] in labels]
    found = {label: sorted(row["score"] for row in rows if labels[row["doc_id"]] == label) for label in (0, 1)}
    assert sum(row["predicted"] == labels[row["doc_id"]] for row in rows) >= 0.92 * len(rows)
    above = sum(low < high for low in found[0] for high in found[1])
    assert above >= 0.95 * len(found[0]) * len(found[1])
    languages = dict(spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang").collect())
    for language in ("en", "de", "es", "fr"):
        toxic = [row["predicted"] for row in rows if labels[row["doc_id"]] and languages[row["doc_id"]] == language]
        assert sum(toxic) >= (0.85 if language == "en" else 0.7) * len(toxic)


def test_fingerprints(spark, documents):
    found = {row["doc_id"]: row for row in entry.queries()["op8_fingerprints"](spark, SF_DIR).collect()}
    ordered = sorted((row["doc_id"], row["text"] or "") for row in documents)
    assert len(found) == len(ordered)
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edit(text, following).encode()).hexdigest()
        assert row["fingerprint"] == fingerprints.fingerprint(text)


def test_ngram_jaccard(spark, documents):
    found = {tuple(row) for row in entry.queries()["op9_ngram_jaccard"](spark, SF_DIR).collect()}
    assert found == brute_groups([(row["doc_id"], row["text"]) for row in documents], 3, 90)


def test_license_scan(spark, documents):
    found = {(row["doc_id"], row["paragraph"]) for row in entry.queries()["op4_license_scan"](spark, SF_DIR).collect()}
    lines = {(row["doc_id"], n) for row in documents for n, line in enumerate((row["text"] or "").split("\n")) if "icense" in line}
    assert found == lines


def test_pipeline_stage_by_stage(spark, documents):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = stages["toxicity"](spark, docs, SF_DIR)
    rows = clean.collect()
    assert clean.columns == docs.columns and 0.7 * len(documents) < len(rows) < len(documents)
    one = stages["exact_dedup"](spark, clean, SF_DIR)
    texts: dict[str, int] = {}
    for row in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"] or "")
        texts[text] = min(texts.get(text, row["doc_id"]), row["doc_id"])
    rows = one.collect()
    assert one.columns == docs.columns and {row["doc_id"] for row in rows} == set(texts.values())
    near = stages["ngram_jaccard"](spark, one, SF_DIR)
    groups = brute_groups([(row["doc_id"], row["text"]) for row in rows], jaccard.WORDS, jaccard.PERCENT)
    rows = near.collect()
    assert near.columns == docs.columns and {row["doc_id"] for row in rows} == {group for _, _, group in groups}
    mixed = stages["mix_sources"](spark, near, SF_DIR)
    copies = {row["doc_id"]: row["copies"] for row in mixing.mix(near).collect()}
    rows = mixed.collect()
    assert mixed.columns == docs.columns
    assert Counter(row["doc_id"] for row in rows) == Counter({doc_id: n for doc_id, n in copies.items() if n})
    check_packed(stages["pack"](spark, mixed, SF_DIR).collect(), token_ids(rows))
