"""The quality classifier: gradients, odd texts, held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidelog.llm import passage_quality

LARGER = "/root/testdata/sf0.1"
WORDS = [f"{a}{b}" for a in ("la", "mo", "ter", "in", "sel") for b in ("ra", "vo", "tin", "es", "um", "ik")]


def prose(draw, count):
    return " ".join(draw.choice(WORDS) for _ in range(count))


@pytest.fixture(scope="module")
def labelled(spark):
    """Junk is one passage in the midst of prose."""
    draw = random.Random(4)
    rows, labels = [], []
    for n in range(160):
        text, good = prose(draw, draw.randint(40, 200)), n % 4 > 0
        if not good:
            text = f"{text} {' '.join(f'{draw.choice(WORDS)}$$' for _ in range(40))} {prose(draw, 60)}"
        rows.append((n, text))
        labels.append((n, int(good)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "x" * 50_000), (904, prose(draw, 40_000)), (905, rows[3][1]),
             (905, rows[3][1]), (None, rows[4][1]), (906, "日本語 ǅ ퟿ ©© 12,5")]
    labels += [(900, 1), (901, 0), (1, None), (2, 7), (5, 1), (5, 0), (None, 1), (4000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("id", "label", "draw", "words", "score", "predicted", "upto"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_of_odd_texts(labelled):
    docs, labels = labelled
    model = passage_quality.fit(docs, labels, F.lit(True))
    found = passage_quality.score(docs, model).collect()
    assert len(found) == docs.count()
    for row in found:
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
    scores = {row["doc_id"]: row["score"] for row in found}
    assert scores[900] == scores[901] == scores[902]
    assert sum(row["predicted"] == int(row["doc_id"] % 4 > 0) for row in found if row["doc_id"] is not None and row["doc_id"] < 160) >= 155
    assert passage_quality.score(docs.limit(0), model).collect() == []
    again = passage_quality.fit(docs.repartition(7), labels, F.lit(True))
    assert all((again.parts[name] == part).all() for name, part in model.parts.items())


def test_quality_without_labels_of_both_classes(labelled):
    docs, labels = labelled
    for kept, wanted in ((labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0), (labels.limit(0), 0.5)):
        model = passage_quality.fit(docs, kept, F.lit(True))
        assert {row["score"] for row in passage_quality.score(docs, model).collect()} == {wanted}


def test_the_sample_takes_whole_texts_within_its_bounds(labelled, monkeypatch):
    docs, labels = labelled
    monkeypatch.setattr(passage_quality, "SAMPLE_WORDS", 2_000)
    monkeypatch.setattr(passage_quality, "LONGEST_SAMPLE", 150)
    rows = passage_quality.sample(docs, labels.withColumnRenamed("quality", "label").where("label IN (0, 1)"), "doc_id", "text").collect()
    lengths = {len(row["text"].split()) for row in docs.where("text IS NOT NULL").collect()}
    for label in (0, 1):
        own = [row["words"] for row in rows if row["label"] == label]
        assert sum(own) <= 2_000 and all(0 < words <= 150 and words in lengths for words in own)


def test_attention_rests_on_the_junk(labelled):
    docs, labels = labelled
    model = passage_quality.fit(docs, labels, F.lit(True))
    words = passage_quality.Words()
    draw = random.Random(9)
    numbers = words.numbers(f"{prose(draw, 96)} {' '.join('tinra$$' if n % 2 else 'moes$$' for n in range(32))} {prose(draw, 64)}")
    looks = passage_quality.passage_looks(numbers, words.looks)
    starts = passage_quality.passage_starts(len(numbers))
    sizes = np.diff(starts, append=len(numbers))
    passages = model.encode(looks, passage_quality._embedded(model, words.buckets[numbers], starts, sizes))
    assert int(model.attend(passages).argmax()) == 3


def test_gradients_against_differences():
    draw = np.random.default_rng(1)
    words = passage_quality.Words()
    texts = ["la ra tin. la", " ".join(WORDS * 3), "A!! B!! c " * 30]
    numbers = [words.numbers(text) for text in texts]
    looks = [passage_quality.passage_looks(own, words.looks) for own in numbers]
    buckets = [words.buckets[own].astype(np.int64) for own in numbers]
    model = passage_quality.train(looks * 4, buckets * 4, np.array([1.0, 0, 1] * 4))
    model.parts = {name: draw.normal(0, 0.3, part.shape) for name, part in model.parts.items()}
    labels, balance = np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])

    def loss():
        logits = passage_quality._logits(model, looks, buckets, np.arange(3))
        return passage_quality._loss(logits, labels, balance)

    found = passage_quality._gradients(model, looks, buckets, labels, balance)
    decay = {"encode": 1e-4, "embedding": 1e-5}
    for name, part in model.parts.items():
        used = np.argwhere(np.abs(found[name] - decay.get(name, 0) * part) > 1e-6)
        for place in map(tuple, used[draw.permutation(len(used))[:4]]):
            kept = part[place]
            part[place] = kept + 1e-6
            above = loss()
            part[place] = kept - 1e-6
            below = loss()
            part[place] = kept
            assert found[name][place] - decay.get(name, 0) * kept == pytest.approx((above - below) / 2e-6, rel=1e-3, abs=1e-7)


def test_passage_looks_by_hand():
    words = passage_quality.Words()
    numbers = words.numbers("a a a b " * 8 + "B!! 12")
    looks = passage_quality.passage_looks(numbers, words.looks)
    assert looks.shape[0] == 2
    assert looks[0, -3:].tolist() == pytest.approx([16 / 32, 2 / 32, np.log1p(32)])
    assert looks[1, -3:].tolist() == pytest.approx([0, 1, np.log1p(2)])
    assert looks[1, 3] == pytest.approx(0.5) and looks[1, 7] == pytest.approx(0.5)


def test_quality_of_held_out_documents(spark):
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = entry.queries()["op12_quality_passages"](spark, LARGER).collect()
    assert len(rows) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    for row in rows[:500]:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
    held = [row for row in rows if row["held_out"] and row["doc_id"] in labels]
    of = {label: [row["predicted"] for row in held if labels[row["doc_id"]] == label] for label in (0, 1)}
    assert sum(of[1]) >= 0.98 * len(of[1]) and sum(of[0]) <= 0.08 * len(of[0])
