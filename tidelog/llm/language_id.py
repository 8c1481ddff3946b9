"""Language of a text: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams are made in numpy where the texts are read and summed up by Spark.
The log-probability matrix, buckets times languages, is broadcast. Texts are scored
many at once: the n-grams of a batch are the entries of a sparse matrix, texts times buckets, which is multiplied with it by
gathering the matrix's rows and adding up those of each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
LONGEST = 3
SAMPLE_ROWS = 8_000  # of each language
UNDETERMINED = "und"
_SMOOTHING = 0.5
_CHARS_AT_ONCE = 1 << 17
_VALUES_AT_ONCE = 1 << 21
# Odd numbers that spread the code points of an n-gram over 32 bits.
_SPREAD = np.array([2654435761, 2246822519, 3266489917], np.uint32)


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages, float32


def letters(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def gram_buckets(codes: np.ndarray, own: int) -> np.ndarray:
    """Buckets of the n-grams that start at the first ``own`` characters: LONGEST rows."""
    padded = np.concatenate([codes, np.full(LONGEST, 32, np.uint32)])
    out = np.empty((LONGEST, own), np.int32)
    mixed = np.zeros(own, np.uint32)
    for n in range(LONGEST):
        mixed = (mixed ^ (padded[n : n + own] + np.uint32(n + 1))) * _SPREAD[n]
        mixed ^= mixed >> np.uint32(15)
        out[n] = mixed & np.uint32(BUCKETS - 1)
    return out


def stretches(text: str) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams, of any length of text a bounded part at a time."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    for first in range(0, len(codes), _CHARS_AT_ONCE):
        part = codes[first : first + _CHARS_AT_ONCE + LONGEST - 1]
        yield gram_buckets(part, min(_CHARS_AT_ONCE, len(codes) - first))


def fit(
    docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Learn from the rows where ``usable`` holds and text and language are not null.

    Of each language about ``sample_rows`` are taken by a hash of the id, whole texts, and all where there are
    fewer, so that a rare language is learnt as well as its rows allow. The
    counts gathered are at most BUCKETS for each language. Without any row the model
    knows no language.
    """
    labelled = docs.where(usable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    labelled = labelled.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("draw")
    )
    rows = docs.where(usable & F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).count().collect()
    parts = [F.lit(x) for row in rows for x in (row["lang"], int(min(1.0, sample_rows / row["count"]) * (1 << 30)))]
    if parts:  # one entry for each language
        labelled = labelled.where(F.pmod("draw", F.lit(1 << 30)) < F.element_at(F.create_map(*parts), F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for buckets in stretches(text):
                    held += np.bincount(buckets.ravel(), minlength=BUCKETS)
        for lang, held in sums.items():
            there = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(there)), pa.array(there), pa.array(held[there])], ["lang", "bucket", "n"]
            )

    counted = labelled.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    counts[found["bucket"], found["lang"].map({lang: i for i, lang in enumerate(languages)}).astype(int)] = found["n"]
    counts += _SMOOTHING
    return LanguageModel(languages, np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32))


def likelihoods(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Log-likelihood of each text in each language."""
    totals = np.zeros((len(texts), len(model.languages)))
    most = max(LONGEST, min(_CHARS_AT_ONCE, _VALUES_AT_ONCE // (LONGEST * max(1, len(model.languages)))))
    held: list[tuple[int, np.ndarray]] = []
    size = 0
    for place, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        if len(codes) > most:  # a long text on its own, a bounded part at a time
            for first in range(0, len(codes), most):
                part = codes[first : first + most + LONGEST - 1]
                rows = model.log_probability[gram_buckets(part, min(most, len(codes) - first))]
                totals[place] += rows.sum(axis=(0, 1), dtype=np.float64)
            continue
        if held and size + len(codes) > most:
            _add_up(model, held, totals)
            held, size = [], 0
        held.append((place, codes))
        size += len(codes) + LONGEST
    if held:
        _add_up(model, held, totals)
    return totals


def _add_up(model: LanguageModel, held: list[tuple[int, np.ndarray]], totals: np.ndarray) -> None:
    """Add the rows of the n-grams of each text, all texts at once; blanks between them stand for the end of a text."""
    held = [(place, codes) for place, codes in held if len(codes)]
    if not held:
        return
    blanks = np.full(LONGEST, 32, np.uint32)
    whole = np.concatenate([part for _, codes in held for part in (codes, blanks)])
    starts = np.cumsum([0, *[len(codes) + LONGEST for _, codes in held]])
    rows = model.log_probability[gram_buckets(whole, len(whole))].sum(axis=0)
    for back in range(1, LONGEST + 1):
        rows[starts[1:] - back] = 0  # n-grams that begin between texts
    totals[[place for place, _ in held]] += np.add.reduceat(rows, starts[:-1], axis=0, dtype=np.float64)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its id, lang_pred, score. Extra columns are not read.

    ``score`` is the posterior of the language under equal priors. A text that is null
    or has no letter, and any text if the model knows no language, is ``und`` with
    score 0. Rows that repeat an id are scored one by one; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(
        F.col(id_col).alias("id"), letters(F.col(text_col)).alias("able"), F.col(text_col).cast("string").alias("text")
    )
    id_type = read.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            able = np.array(batch.column("able").to_pylist(), bool) & bool(known.languages)
            names, scores = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows)
            if able.any():
                texts = batch.column("text").filter(pa.array(able)).to_pylist()
                totals = likelihoods(known, texts)
                best = totals.argmax(axis=1)
                names[able] = np.array(known.languages, object)[best]
                away = totals - totals[np.arange(len(texts)), best][:, None]
                scores[able] = 1 / np.exp(away).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"],
            )

    predicted = read.mapInArrow(score, f"id {id_type}, lang_pred string, score double")
    return predicted.withColumnRenamed("id", id_col)
