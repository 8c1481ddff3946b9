"""Quality of a text by its passages: attention-based multiple-instance learning.

A text is cut into passages of a fixed number of words. Every passage is encoded: the mean of what its
words look like and of their hashed embeddings, and how much it repeats itself. Labels belong
to documents, not to passages; a gated attention (tanh times sigmoid) learns which passages of a document its label rests
on, and the mean of the passages under these weights is scored. Encoder, attention and score
are trained together in numpy on a bounded sample of labelled texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.toxicity import marked

PASSAGE_WORDS = 32
THRESHOLD = 0.7
# Learnt from: so many documents of each class at most, with so many words in all and each.
SAMPLE_ROWS = 6_000
SAMPLE_WORDS = 1_500_000
LONGEST_SAMPLE = 100_000
LETTER_BUCKETS = 1 << 13
MARK_BUCKETS = 1 << 9
EMBEDDING = 8
REPRESENTATION = 16
ATTENTION = 8
EPOCHS = 10
_LEAST_STEPS = 500
_BATCH = 32
_KNOWN_WORDS = 300_000
_WORDS_AT_ONCE = 1 << 18
_LOOKS = 10
_OF_PASSAGE = _LOOKS + 3
_LETTERS = re.compile(r"[^\W\d_]+")


def look(word: str) -> tuple[list[float], int, int]:
    """What a word looks like, the bucket of its letters and that of its other characters."""
    length = len(word)
    marks = "" if word.isalpha() else _LETTERS.sub("", word)
    letters = length - len(marks)
    upper = 0 if word.islower() else sum(map(str.isupper, word))
    digits = sum(map(str.isdigit, marks))
    looks = [
        np.log1p(length), letters / length, upper / max(1, letters), digits / length, (len(marks) - digits) / length,
        len(marks) > 1, upper == letters > 1, letters == 0, word[0].isupper(), word.isascii(),
    ]
    plain = word.lower() if letters == length else "".join(_LETTERS.findall(word.lower()))
    letter_bucket = zlib.crc32(plain.encode("utf-8", "surrogatepass")) % LETTER_BUCKETS
    return looks, letter_bucket, LETTER_BUCKETS + zlib.crc32(marks.encode("utf-8", "surrogatepass")) % MARK_BUCKETS


class Words(dict):
    """Numbers of words as they come up, with their looks and buckets; emptied between texts once it is large."""

    def __init__(self):
        super().__init__()
        self.looks = np.zeros((1024, _LOOKS), np.float32)
        self.buckets = np.zeros((1024, 2), np.int32)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number == len(self.looks):
            self.looks = np.concatenate([self.looks, np.zeros_like(self.looks)])
            self.buckets = np.concatenate([self.buckets, np.zeros_like(self.buckets)])
        self.looks[number], *self.buckets[number] = look(word)
        self[word] = number
        return number

    def numbers(self, text: str) -> np.ndarray:
        return np.array(list(map(self.__getitem__, text.split())), np.int64)


def passage_starts(words: int) -> np.ndarray:
    return np.arange(0, words, PASSAGE_WORDS)


def passage_looks(numbers: np.ndarray, looks: np.ndarray) -> np.ndarray:
    """One row for each passage of a text: the mean looks of its words, and how much they repeat."""
    starts = passage_starts(len(numbers))
    sizes = np.diff(starts, append=len(numbers))[:, None].astype(np.float32)
    means = np.add.reduceat(looks[numbers], starts) / sizes
    again = np.zeros(len(numbers), np.float32)
    again[1:] = numbers[1:] == numbers[:-1]
    padded = np.full(len(starts) * PASSAGE_WORDS, -1)
    padded[: len(numbers)] = numbers
    ordered = np.sort(padded.reshape(-1, PASSAGE_WORDS), axis=1)
    distinct = 1 + (ordered[:, 1:] != ordered[:, :-1]).sum(axis=1) - (ordered[:, 0] == -1)
    repeats = np.add.reduceat(again, starts)[:, None] / sizes
    return np.hstack([means, repeats, distinct[:, None] / sizes, np.log1p(sizes)]).astype(np.float32)


@dataclass
class QualityModel:
    """The trained parts; without any, every score is ``constant``."""

    parts: dict[str, np.ndarray] = field(default_factory=dict)
    mean: np.ndarray | None = None  # of passage looks
    spread: np.ndarray | None = None
    cut: float = 0.0  # the logit that stands for the threshold
    constant: float = 0.5

    def encode(self, looks: np.ndarray, embedded: np.ndarray) -> np.ndarray:
        """Passages as representations, from their looks and the mean embedding of their words."""
        whole = np.hstack([(looks - self.mean) / self.spread, embedded])
        return np.tanh(whole @ self.parts["encode"] + self.parts["encode_bias"])

    def attend(self, passages: np.ndarray) -> np.ndarray:
        """The weight, before it is normalised, of each passage."""
        gate = 1 / (1 + np.exp(-np.clip(passages @ self.parts["gate"], -30, 30)))
        return (np.tanh(passages @ self.parts["attend"]) * gate) @ self.parts["weigh"]

    def logit(self, passages: np.ndarray) -> float:
        if not len(passages):
            return float(self.parts["constant"][0])
        weights = self.attend(passages)
        weights = np.exp(weights - weights.max())
        return float((weights / weights.sum()) @ passages @ self.parts["score"] + self.parts["constant"][0])

    def score_of(self, logit: float, threshold: float) -> float:
        """0 to 1, with ``threshold`` where the cut is."""
        shifted = np.clip(logit - self.cut + np.log(threshold / (1 - threshold)), -500, 500)
        return float(1 / (1 + np.exp(-shifted)))


class Scorer:
    """Logits of texts, with words that came up before kept up to a fixed number."""

    def __init__(self, model: QualityModel):
        self._model = model
        self._words = Words()

    def logit(self, text: str) -> float:
        if len(self._words) > _KNOWN_WORDS:
            self._words = Words()
        numbers = self._words.numbers(text)
        parts = [self._passages(numbers[at : at + _WORDS_AT_ONCE]) for at in range(0, len(numbers), _WORDS_AT_ONCE)]
        return self._model.logit(np.concatenate(parts) if parts else np.zeros((0, REPRESENTATION)))

    def _passages(self, numbers: np.ndarray) -> np.ndarray:
        """Of a run of whole passages."""
        table = self._model.parts["embedding"]
        starts = passage_starts(len(numbers))
        buckets = self._words.buckets[numbers]
        sums = np.add.reduceat(table[buckets[:, 0]] + table[buckets[:, 1]], starts)
        sizes = np.diff(starts, append=len(numbers))[:, None]
        return self._model.encode(passage_looks(numbers, self._words.looks), sums / sizes)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Passage looks and word buckets of labelled documents, by a hash of the id and within the bounds.

    Texts are taken whole or not at all.
    """
    drawn = [
        labels.where(F.col("label") == value).orderBy(F.xxhash64(id_col, F.lit("passages")), id_col).limit(SAMPLE_ROWS)
        for value in (0, 1)
    ]
    chosen = F.broadcast(drawn[0].union(drawn[1]))  # bounded by SAMPLE_ROWS
    known = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, id_col)
    read = known.select(F.xxhash64(id_col, F.lit("passages")).alias("draw"), "label", "text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], []]
            words = Words()
            for text in batch.column("text").to_pylist():
                numbers = words.numbers(text)
                columns[0].append(len(numbers))
                columns[1].append(passage_looks(numbers, words.looks).tobytes() if len(numbers) else b"")
                columns[2].append(words.buckets[numbers].astype("<u2").tobytes())
            arrays = [pa.array(columns[0], pa.int64()), *[pa.array(column, pa.binary()) for column in columns[1:]]]
            yield pa.RecordBatch.from_arrays([batch.column("draw"), batch.column("label"), *arrays], names)

    names = ["draw", "label", "words", "looks", "buckets"]
    rows = read.mapInArrow(encoded, "draw long, label int, words long, looks binary, buckets binary")
    before = Window.partitionBy("label").orderBy("draw", "words", "buckets")
    short = rows.where(F.col("words").between(1, LONGEST_SAMPLE)).withColumn("upto", F.sum("words").over(before))
    return short.where(F.col("upto") <= SAMPLE_WORDS).drop("upto")


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality",
    id_col: str = "doc_id", text_col: str = "text",
) -> QualityModel:
    """Train on labelled documents where ``usable``, a condition on the id, holds.

    The driver gets passages of at most SAMPLE_ROWS documents and SAMPLE_WORDS words of each class. Of rows that repeat an id
    in ``labels`` the larger label counts; null labels and other values than 0 and 1, and
    texts without a word, are left out. Where only one class is seen all texts score that class, where none is, 0.5.
    """
    own = marked(labels.select(F.col(id_col), F.col(label_col).alias("label")), usable, id_col)
    rows = sample(docs, own, id_col, text_col).collect()
    rows.sort(key=lambda row: (row["draw"], bytes(row["buckets"])))  # the same order, and model, in each run
    looks = [np.frombuffer(bytes(row["looks"]), np.float32).reshape(-1, _OF_PASSAGE) for row in rows]
    buckets = [np.frombuffer(bytes(row["buckets"]), "<u2").reshape(-1, 2).astype(np.int64) for row in rows]
    return train(looks, buckets, np.array([row["label"] for row in rows], np.float64))


def train(looks: list[np.ndarray], buckets: list[np.ndarray], labels: np.ndarray) -> QualityModel:
    """The model of documents given as passage looks and word buckets; every fifth only chooses the pass and sets the cut."""
    seen = set(labels.tolist())
    if len(seen) < 2:
        return QualityModel(constant=seen.pop() if seen else 0.5)
    every = np.concatenate(looks)
    model = QualityModel(mean=every.mean(axis=0), spread=every.std(axis=0) + 1e-3)
    draw = np.random.default_rng(5)
    model.parts = {
        "embedding": draw.normal(0, 0.05, (LETTER_BUCKETS + MARK_BUCKETS, EMBEDDING)),
        "encode": draw.normal(0, 0.3, (_OF_PASSAGE + EMBEDDING, REPRESENTATION)),
        "encode_bias": np.zeros(REPRESENTATION),
        "attend": draw.normal(0, 0.3, (REPRESENTATION, ATTENTION)),
        "gate": draw.normal(0, 0.3, (REPRESENTATION, ATTENTION)),
        "weigh": draw.normal(0, 0.3, ATTENTION),
        "score": draw.normal(0, 0.3, REPRESENTATION),
        "constant": np.zeros(1),
    }
    # every fifth of each class is held back
    held = np.zeros(len(labels), bool)
    for label in (0, 1):
        held[np.flatnonzero(labels == label)[4::5]] = True
    learn = np.flatnonzero(~held)
    balance = np.where(labels == 1, 0.5 / max(1e-9, labels[learn].mean()), 0.5 / max(1e-9, 1 - labels[learn].mean()))
    moments = {name: [np.zeros_like(part), np.zeros_like(part)] for name, part in model.parts.items()}
    step, best_loss, best_parts = 0, np.inf, model.parts
    for _ in range(max(EPOCHS, _LEAST_STEPS * _BATCH // max(1, len(learn)))):
        for batch in np.array_split(draw.permutation(learn), max(1, len(learn) // _BATCH)):
            step += 1
            gradients = _gradients(model, [looks[i] for i in batch], [buckets[i] for i in batch], labels[batch], balance[batch])
            for name, gradient in gradients.items():
                mean, square = moments[name]
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient**2 - square)
                size = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                model.parts[name] -= size * mean / (np.sqrt(square) + 1e-8)
        chosen = np.flatnonzero(held) if held.any() else learn
        loss = _loss(_logits(model, looks, buckets, chosen), labels[chosen], balance[chosen])
        if loss < best_loss:
            best_loss, best_parts = loss, {name: part.copy() for name, part in model.parts.items()}
    model.parts = {name: part.astype(np.float32) for name, part in best_parts.items()}
    chosen = np.flatnonzero(held) if len(set(labels[held].tolist())) == 2 else np.arange(len(labels))
    model.cut = balanced_cut(_logits(model, looks, buckets, chosen), labels[chosen])
    return model


def _embedded(model: QualityModel, buckets: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    table = model.parts["embedding"]
    return np.add.reduceat(table[buckets[:, 0]] + table[buckets[:, 1]], starts) / sizes[:, None]


def _logits(model: QualityModel, looks: list[np.ndarray], buckets: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    logits = []
    for i in chosen:
        starts = passage_starts(len(buckets[i]))
        sizes = np.diff(starts, append=len(buckets[i]))
        logits.append(model.logit(model.encode(looks[i], _embedded(model, buckets[i], starts, sizes))))
    return np.array(logits)


def _loss(logits: np.ndarray, labels: np.ndarray, balance: np.ndarray) -> float:
    return float((np.logaddexp(0, np.where(labels == 1, -logits, logits)) * balance).mean())


def _gradients(
    model: QualityModel, looks: list[np.ndarray], buckets: list[np.ndarray], labels: np.ndarray, balance: np.ndarray
) -> dict[str, np.ndarray]:
    """Of the weighted loss of a batch of documents, by all parts."""
    parts = model.parts
    counts = np.array([len(own) for own in looks])
    documents = np.repeat(np.arange(len(looks)), counts)
    first_passages = np.cumsum(counts) - counts
    first_words = np.cumsum([0, *[len(own) for own in buckets]])
    starts = np.concatenate([at + passage_starts(len(own)) for at, own in zip(first_words, buckets)])
    words = np.concatenate(buckets)
    sizes = np.diff(starts, append=len(words))
    whole = np.hstack([(np.concatenate(looks) - model.mean) / model.spread, _embedded(model, words, starts, sizes)])
    passages = np.tanh(whole @ parts["encode"] + parts["encode_bias"])
    bent = np.tanh(passages @ parts["attend"])
    gate = 1 / (1 + np.exp(-np.clip(passages @ parts["gate"], -30, 30)))
    raw = (bent * gate) @ parts["weigh"]
    raw = np.exp(raw - np.maximum.reduceat(raw, first_passages)[documents])
    weights = raw / np.add.reduceat(raw, first_passages)[documents]
    pooled = np.add.reduceat(weights[:, None] * passages, first_passages)
    logits = pooled @ parts["score"] + parts["constant"][0]

    error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) * balance / len(labels)
    found = {"score": pooled.T @ error, "constant": np.array([error.sum()])}
    to_pooled = error[:, None] * parts["score"]
    to_weights = (to_pooled[documents] * passages).sum(axis=1)
    to_raw = weights * (to_weights - np.add.reduceat(weights * to_weights, first_passages)[documents])
    found["weigh"] = (bent * gate).T @ to_raw
    to_bent = to_raw[:, None] * parts["weigh"] * gate * (1 - bent**2)
    to_gate = to_raw[:, None] * parts["weigh"] * bent * gate * (1 - gate)
    found["attend"], found["gate"] = passages.T @ to_bent, passages.T @ to_gate
    to_passages = weights[:, None] * to_pooled[documents] + to_bent @ parts["attend"].T + to_gate @ parts["gate"].T
    to_whole = to_passages * (1 - passages**2)
    found["encode"] = whole.T @ to_whole + 1e-4 * parts["encode"]
    found["encode_bias"] = to_whole.sum(axis=0)
    to_words = np.repeat((to_whole @ parts["encode"][_OF_PASSAGE:].T) / sizes[:, None], sizes, axis=0)
    rows = parts["embedding"].shape[0]
    found["embedding"] = np.stack(
        [np.bincount(words.T.ravel(), np.tile(to_words[:, d], 2), rows) for d in range(EMBEDDING)], axis=1
    ) + 1e-5 * parts["embedding"]
    return found


def balanced_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap between two logits at which the mean of both classes' recalls is best."""
    order = np.argsort(-logits, kind="stable")
    ones = labels[order] == 1
    gain = np.cumsum(np.where(ones, 1 / max(1, ones.sum()), -1 / max(1, (~ones).sum())))
    ordered = logits[order]
    gain[:-1][ordered[:-1] == ordered[1:]] = -np.inf  # no cut between equal scores
    cut = int(gain.argmax())
    below = ordered[cut + 1] if cut + 1 < len(ordered) else ordered[cut] - 1
    return float((ordered[cut] + below) / 2)


def score(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row for each document: its id, score (higher: label 1 likelier), predicted (1 from ``threshold``).

    Only the text is read, all of it, however long. A null text is empty; a text without a word has the score of no passage at all.
    Rows that repeat an id are scored one by one; an empty table gives no rows; extra columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = read.schema["id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = Scorer(model)
        for batch in batches:
            if model.parts:
                found = [model.score_of(scorer.logit(text.as_py() or ""), threshold) for text in batch.column("text")]
            else:
                found = [model.constant] * batch.num_rows
            scores = np.array(found, np.float64)
            columns = [batch.column("id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "score", "predicted"])

    return read.mapInArrow(scored, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)
