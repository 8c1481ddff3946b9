"""Toxicity of a text: a convolutional classifier over hashed word embeddings.

Every word has an embedding: the sum of those of a few buckets, to which the word and its beginnings are hashed, so that
inflected forms share what is learnt. A bucket that no learning text touched is zero. Filters of several
widths run over the words, each is pooled by its maximum over the whole text, and a logistic layer gives the score. It is trained in numpy
on a bounded sample of labelled texts, in which languages and classes are balanced. The model also knows
from its learning texts how often each word comes up in each language; the language it
finds in the words of a text, no column, selects the threshold, and the score is shifted so that
the threshold is 0.5. Thresholds are set on all labelled texts that the filters were not fitted on,
counted by Spark, with each class weighing what it has among all labelled texts.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import give_back, runs, strings

WIDTHS = (1, 2, 3)
FILTERS = 8
WIDTH_OF_EMBEDDING = 16
SAMPLE_ROWS = {1: 4_000, 0: 8_000}
# and so many characters in all texts of a class; texts are taken whole or not at all
SAMPLE_CHARS = {1: 16_000_000, 0: 32_000_000}
BUCKETS = 1 << 17
# Beginnings of a word's UTF-8 bytes that are hashed, beside the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)
EPOCHS = 6
_BATCH = 64
_LEAST_STEPS = 800
# A bucket in so many learning texts is learnt at half the rate.
_DOUBT = 10
_HIDDEN = 0.2
# So many toxic texts at least set a threshold.
_LEAST_TOXIC = 20
# Logits are counted in bins of equal width of their inverse hyperbolic sine.
_BINS = 256
_BYTES_AT_ONCE = 4 << 20  # of texts whose words are told apart together, beside the first
_WORDS_AT_ONCE = 4096
_WORDS = re.compile(r"[^\W\d_]+")
# the same letters, as a set that is looked up faster, for texts without others
_LATIN_WORDS = re.compile(f"[{''.join(filter(_WORDS.fullmatch, map(chr, range(256))))}]+")


def _crc_table() -> np.ndarray:
    """What CRC-32 makes of each byte."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(0xEDB88320), values >> 1)
    return values


_CRC = _crc_table()


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, in lower case."""
    text = text.lower()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORDS.findall(text)
    return _LATIN_WORDS.findall(text)


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word the buckets of the whole word, then of its beginnings, all one after the other; and how many each has."""
    raw = [word.encode("utf-8", "surrogatepass") for word in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    firsts, flat = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(raw), np.uint8)
    there = np.stack([lengths >= 0, *[length < lengths for length in BEGINNINGS]], axis=1)
    table = np.zeros(there.shape, np.int32)
    table[:, 0] = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % BUCKETS
    for column, length in enumerate(BEGINNINGS, 1):
        rows = np.flatnonzero(there[:, column])
        state = np.full(len(rows), length ^ 0xFFFFFFFF, np.uint32)  # as zlib.crc32(beginning, length)
        for offset in range(length):
            state = _CRC[(state ^ flat[firsts[rows] + offset]) & 0xFF] ^ (state >> 8)
        table[rows, column] = (state ^ 0xFFFFFFFF) % BUCKETS
    return table[there], there.sum(axis=1)


@dataclass
class ToxicityModel:
    embedding: np.ndarray | None = None  # buckets x WIDTH_OF_EMBEDDING
    kernel: np.ndarray | None = None  # WIDTH_OF_EMBEDDING x (sum of widths * FILTERS)
    bias: np.ndarray | None = None  # of the filters, widths x FILTERS
    weights: np.ndarray | None = None  # of the pooled filters
    constant: float = 0.0
    by_language: np.ndarray | None = None  # buckets x languages, log-probability of a word
    thresholds: np.ndarray | None = None  # one for each language

    @cached_property
    def filters(self) -> np.ndarray:
        """Buckets x (sum of widths * FILTERS): embedding times each filter's columns, made where texts are scored."""
        return self.embedding @ self.kernel

    def __getstate__(self) -> dict:
        """Without the filters, three times as large as what they are made from."""
        return {name: value for name, value in self.__dict__.items() if name != "filters"}

    def logit(self, responses: np.ndarray) -> float:
        """Of a text as one row of filter responses for each word."""
        pooled = pooled_best([responses[:, first:last] for first, last in spans()], len(responses))
        return float(np.maximum(pooled + self.bias, 0).ravel() @ self.weights + self.constant)


def spans() -> list[tuple[int, int]]:
    """Columns of each filter bank's offsets, one after the other."""
    edges = np.arange(sum(WIDTHS) + 1) * FILTERS
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _banks(columns: list[np.ndarray], words: int) -> Iterator[np.ndarray]:
    """The responses of each width's filters at each word; texts are followed by zeros."""
    first = 0
    for width in WIDTHS:
        response = columns[first].copy()
        for offset in range(1, width):
            response[: words - offset] += columns[first + offset][offset:] if words > offset else 0
        yield response
        first += width


def pooled_best(columns: list[np.ndarray], words: int) -> np.ndarray:
    """The largest response of each filter over the words."""
    if not words:
        return np.zeros((len(WIDTHS), FILTERS), np.float32)
    return np.stack([response.max(axis=0) for response in _banks(columns, words)])


def pool(columns: list[np.ndarray], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter over the words and where it is."""
    best, where = np.zeros((len(WIDTHS), FILTERS), np.float32), np.zeros((len(WIDTHS), FILTERS), np.int64)
    if not words:
        return best, where
    for bank, response in enumerate(_banks(columns, words)):
        where[bank] = response.argmax(axis=0)
        best[bank] = response[where[bank], np.arange(FILTERS)]
    return best, where


def marked(labels: DataFrame, usable: Column, id_col: str) -> DataFrame:
    """The label of each usable id."""
    return labels.where(usable & F.col("label").isin(0, 1)).groupBy(id_col).agg(F.max("label").cast("int").alias("label"))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most SAMPLE_ROWS documents of each class of ``marked`` labels, drawn by a hash of the id."""
    drawn = [
        labels.where(F.col("label") == value).orderBy(F.xxhash64(id_col, F.lit("draw")), id_col).limit(most)
        for value, most in SAMPLE_ROWS.items()
    ]
    chosen = F.broadcast(drawn[0].union(drawn[1]))  # bounded by SAMPLE_ROWS
    known = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang"))
    rows = known.join(chosen, id_col).select(F.xxhash64(id_col).alias("draw"), "label", "lang", "text")
    before = Window.partitionBy("label").orderBy("draw", "text")
    bound = F.when(F.col("label") == 1, SAMPLE_CHARS[1]).otherwise(SAMPLE_CHARS[0])
    return rows.withColumn("upto", F.sum(F.length("text")).over(before)).where(F.col("upto") <= bound).drop("upto")


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "toxic",
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> ToxicityModel:
    """Train on labelled documents where ``usable``, a condition on the id, holds.

    The driver gets at most SAMPLE_ROWS texts of each class, of SAMPLE_CHARS characters in all, and counts of the scores of all
    labelled documents, by which the thresholds are set. Of rows that repeat an id in
    ``labels`` the larger label counts; null labels and other values than 0 and 1 are
    left out. Without labelled documents of both classes the model scores 0.
    """
    labels = marked(labels.select(F.col(id_col), F.col(label_col).alias("label")), usable, id_col)

    rows = sample(docs, labels, id_col, text_col, lang_col).orderBy("draw", "text").toArrow()  # the same order, and model, in each run
    draws = rows.column("draw").to_pylist()
    marks = rows.column("label").to_numpy().astype(np.float32)
    languages = [language or "" for language in rows.column("lang").to_pylist()]
    words = Vocabulary(rows.column("text"))
    del rows  # the driver holds the texts or what is learnt from them, not both
    held = np.arange(len(draws)) % 5 == 4
    model = train(words, marks, languages, held)
    del words
    give_back()
    if model.embedding is not None:
        learnt = {draw for draw, out in zip(draws, held) if not out}
        _fit_thresholds(model, *_counted(docs.where(usable), labels, model, learnt, id_col, text_col))
    return model


def _counted(
    docs: DataFrame, labels: DataFrame, model: ToxicityModel, learnt: set[int], id_col: str, text_col: str
) -> list[np.ndarray]:
    """How many labelled documents there are by language found, logit, label and whether they were learnt from.

    Texts are scored where they are read, so that only ids meet their labels and no text is shuffled; ``learnt`` are
    hashes of ids. One row comes back for each bin of logits in use, at most.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = read.schema["id"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            found, logits = scorer.marks(batch.column("text"))
            bins = np.rint(np.arcsinh(logits) * _BINS).astype(np.int32)
            columns = [batch.column("id"), pa.array(found.astype(np.int32)), pa.array(bins)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "found", "bin"])

    scored = read.mapInArrow(placed, f"id {id_type}, found int, bin int").withColumnRenamed("id", id_col)
    seen = spark.createDataFrame([(draw, True) for draw in sorted(learnt)], "draw long, learnt boolean")
    known = scored.join(labels, id_col).withColumn("draw", F.xxhash64(id_col)).join(F.broadcast(seen), "draw", "left")
    rows = known.groupBy("found", "bin", "label", F.coalesce("learnt", F.lit(False)).alias("learnt")).count().collect()
    shared.unpersist()  # the executors get another one, with thresholds
    columns = np.array([tuple(row) for row in rows], np.int64).reshape(-1, 5).T
    return [columns[0], np.sinh(columns[1] / _BINS), columns[2], columns[3] == 1, columns[4]]


class Vocabulary:
    """The words of the learning texts, numbered, and the buckets of each, one after the other.

    The texts are parts of one array, which the driver gives back whole.
    """

    def __init__(self, texts: Iterable[pa.Scalar]):
        numbers: dict[str, int] = {}
        run, ends = array("i"), [0]
        for text in texts:
            run.extend([numbers.setdefault(word, len(numbers)) for word in words_of(text.as_py())])
            ends.append(len(run))
        every = np.frombuffer(run, np.int32)
        self.texts = [every[first:last] for first, last in zip(ends, ends[1:])]
        self.buckets, self.sizes = buckets_of(list(numbers))
        self.firsts = np.cumsum(self.sizes) - self.sizes

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of some words, and where those of each word begin."""
        sizes = self.sizes[words]
        begins = np.cumsum(sizes) - sizes
        places = np.repeat(self.firsts[words] - begins, sizes) + np.arange(sizes.sum())
        return self.buckets[places], begins

    def sums(self, table: np.ndarray, text: np.ndarray) -> np.ndarray:
        """For each word of a text the sum of its buckets' rows."""
        if not len(text):
            return np.zeros((0, table.shape[1]), table.dtype)
        words, inverse = np.unique(text, return_inverse=True)
        buckets, begins = self.of(words)
        return np.add.reduceat(table[buckets], begins)[inverse]


def train(words: Vocabulary, labels: np.ndarray, languages: list[str], held: np.ndarray) -> ToxicityModel:
    """The model, without thresholds. The ``held`` texts only choose the pass."""
    model = ToxicityModel()
    if len(set(labels.tolist())) < 2:
        return model
    _fit_filters(model, words, labels, _balance(labels, languages, ~held), np.flatnonzero(~held), np.flatnonzero(held))
    _fit_languages(model, words, languages)
    return model


def _balance(labels: np.ndarray, languages: list[str], learning: np.ndarray) -> np.ndarray:
    """A weight for each text: both classes of a language weigh the same, and a rare language, up to a point, as much as others."""
    own = np.array(languages, object)
    weights = np.ones(len(labels), np.float64)
    largest = max(((own == language) & learning).sum() for language in set(languages))
    for language in set(languages):
        rows = own == language
        share = min(4.0, np.sqrt(largest / max(1, (rows & learning).sum())))
        toxic = max(1, (rows & learning & (labels == 1)).sum())
        clean = max(1, (rows & learning & (labels == 0)).sum())
        weights[rows] = share * np.where(labels[rows] == 1, min(20.0, max(1.0, clean / toxic)), 1.0)
    return weights


class _Adam:
    """Adam's steps for one array; ``rows`` limits a step to those."""

    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.step = value, rate, 0
        self.mean, self.square = np.zeros_like(value), np.zeros_like(value)

    def update(self, gradient: np.ndarray, rows=slice(None), share: np.ndarray | float = 1.0) -> None:
        """One step; ``share`` of it is taken."""
        self.step += 1
        self.mean[rows] = 0.9 * self.mean[rows] + 0.1 * gradient
        self.square[rows] = 0.999 * self.square[rows] + 0.001 * gradient**2
        size = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        self.value[rows] -= share * size * self.mean[rows] / (np.sqrt(self.square[rows]) + 1e-8)


def _loss(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    return float((np.logaddexp(0, np.where(labels == 1, -logits, logits)) * weights).mean())


def _fit_filters(
    model: ToxicityModel, words: Vocabulary, labels: np.ndarray, balance: np.ndarray, train_on: np.ndarray, held: np.ndarray
) -> None:
    """Passes over the learning texts; what stays is the pass that does best on the held ones."""
    draw = np.random.default_rng(7)
    banks, ids = len(WIDTHS), words.texts
    embedding = _Adam(np.zeros((BUCKETS, WIDTH_OF_EMBEDDING), np.float32), 0.02)
    kernel = _Adam(draw.normal(0, 0.3, (WIDTH_OF_EMBEDDING, sum(WIDTHS) * FILTERS)).astype(np.float32), 0.01)
    bias = _Adam(np.full((banks, FILTERS), 0.1, np.float32), 0.01)
    weights = _Adam(draw.normal(0, 0.3, banks * FILTERS).astype(np.float32), 0.01)
    constant = _Adam(np.array([-1.0], np.float32), 0.01)
    offsets = [(bank, offset) for bank, width in enumerate(WIDTHS) for offset in range(width)]
    passes = max(EPOCHS, _LEAST_STEPS * _BATCH // max(1, len(train_on)))
    # Adam's steps are as large for a bucket of one text as for one of many, and would learn that text by heart
    seen = np.zeros(BUCKETS)
    for i in train_on:
        seen[np.unique(words.of(np.unique(ids[i]))[0])] += 1
    trust = (seen / (seen + _DOUBT)).astype(np.float32)
    best_loss = np.inf
    for _ in range(passes):
        for batch in np.array_split(draw.permutation(train_on), max(1, len(train_on) // _BATCH)):
            used_words, inverse = np.unique(np.concatenate([ids[i] for i in batch]), return_inverse=True)
            if len(used_words):
                buckets, begins = words.of(used_words)
                responses = np.add.reduceat(embedding.value[buckets], begins) @ kernel.value
            else:
                responses = np.zeros((0, kernel.value.shape[1]), np.float32)
            by_word = np.zeros_like(responses)
            gradients = [np.zeros_like(x.value) for x in (bias, weights, constant)]
            first = 0
            for i in batch:
                count = len(ids[i])
                own = inverse[first : first + count]
                first += count
                text = responses[own]
                shown = draw.random(count) >= _HIDDEN  # some words are hidden, so that no text is learnt by heart
                text[~shown] = 0
                best, where = pool([text[:, a:b] for a, b in spans()], count)
                active = np.maximum(best + bias.value, 0)
                z = float(active.ravel() @ weights.value + constant.value[0])
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]) * balance[i] / len(batch)
                back = error * weights.value.reshape(active.shape) * (active > 0)
                gradients[0] += back
                gradients[1] += error * active.ravel()
                gradients[2] += error
                if count:
                    for column, (bank, offset) in enumerate(offsets):
                        at = where[bank] + offset
                        inside = at < count
                        inside[inside] = shown[at[inside]]
                        columns = column * FILTERS + np.arange(FILTERS)
                        np.add.at(by_word, (own[at[inside]], columns[inside]), back[bank][inside])
            used = np.flatnonzero(by_word.any(axis=1))
            if len(used):
                buckets, begins = words.of(used_words[used])
                sums = np.add.reduceat(embedding.value[buckets], begins)
                to_words = by_word[used] @ kernel.value.T
                kernel.update(sums.T @ by_word[used] + 1e-5 * kernel.value)
                rows, place = np.unique(buckets, return_inverse=True)
                to_rows = np.zeros((len(rows), WIDTH_OF_EMBEDDING), np.float32)
                np.add.at(to_rows, place, np.repeat(to_words, np.diff(begins, append=len(buckets)), axis=0))
                embedding.update(to_rows, rows, trust[rows, None])
            for part, gradient in zip((bias, weights, constant), gradients):
                part.update(gradient)
        now = ToxicityModel(embedding.value, kernel.value, bias.value, weights.value, float(constant.value[0]))
        logits = np.array([now.logit(words.sums(now.filters, ids[i])) for i in held])
        loss = _loss(logits, labels[held], balance[held]) if len(held) else 0.0
        if loss < best_loss:
            best_loss = loss
            model.embedding, model.kernel = embedding.value.copy(), kernel.value.copy()
            model.bias, model.weights, model.constant = bias.value.copy(), weights.value.copy(), now.constant
        del now  # with its filters, before those of the next pass are made


def _fit_languages(model: ToxicityModel, words: Vocabulary, languages: list[str]) -> None:
    names = sorted(set(languages))
    counts = np.full((BUCKETS, len(names)), 0.5)
    for text, language in zip(words.texts, languages):
        np.add.at(counts[:, names.index(language)], words.buckets[words.firsts[text]], 1)
    counts[(counts == 0.5).all(axis=1)] = counts.sum(axis=0)  # words that are not known say nothing
    found = np.log(counts / counts.sum(axis=1, keepdims=True) / (counts.sum(axis=0) / counts.sum()))
    model.by_language = found.astype(np.float32)


def _fit_thresholds(
    model: ToxicityModel, found: np.ndarray, logits: np.ndarray, labels: np.ndarray, learnt: np.ndarray, counts: np.ndarray
) -> None:
    """For each language found, the middle of the gap where F1 over the texts not learnt from is best.

    Each row stands for ``counts`` texts. Those not learnt from stand for all of their class,
    since a class that was sampled in part has left more of them than another. A language with few
    toxic texts among them uses all its texts, one with fewer still the threshold of all.
    """
    held = ~learnt
    weights = counts.astype(np.float64)
    for label in (0, 1):
        own = labels == label
        weights[own & held] *= counts[own].sum() / max(1, counts[own & held].sum())

    def cut(rows: np.ndarray) -> float | None:
        for chosen, weighing in ((rows & held, weights), (rows, counts)):
            if (counts * labels)[chosen].sum() >= _LEAST_TOXIC:
                return best_cut(logits[chosen], labels[chosen], weighing[chosen])
        return None

    everywhere = cut(np.full(len(counts), True))
    if everywhere is None:
        everywhere = best_cut(logits, labels, counts)
    by_language = [cut(found == language) for language in range(model.by_language.shape[1])]
    model.thresholds = np.array([(everywhere or 0.0) if own is None else own for own in by_language])


def best_cut(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float | None:
    """The logit between two texts at which F1 of the weighted texts is best; None without toxic texts."""
    if not labels.sum():
        return None
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum((weights * labels)[order])
    f1 = 2 * hits / (np.cumsum(weights[order]) + hits[-1])
    ordered = logits[order]
    f1[:-1][ordered[:-1] == ordered[1:]] = -1  # no cut between equal scores
    cut = int(f1.argmax())
    below = ordered[cut + 1] if cut + 1 < len(ordered) else ordered[cut] - 1
    return float((ordered[cut] + below) / 2)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its id, score, predicted.

    ``predicted`` is 1 where score is 0.5 or more. Only the text is read. Null texts are
    empty; an empty text, or one without known words, has the score of silence. Rows that
    repeat an id are scored one by one; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = read.schema["id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores_of = _Scorer(shared.value)
        for batch in batches:
            values = scores_of(batch.column("text"))
            columns = [batch.column("id"), pa.array(values), pa.array((values >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "score", "predicted"])

    return read.mapInArrow(scored, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all columns of the input.

    A null or empty text is judged as silence; rows that repeat an id are judged one by one; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores_of = _Scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(scores_of(batch.column(place)) < 0.5))

    return docs.mapInArrow(clean, docs.schema)


class _Scorer:
    """Scores of texts. Words are told apart by Arrow, so that the filters meet each once for all texts that are given together."""

    def __init__(self, model: ToxicityModel):
        self._model = model

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """0 to 1, with the threshold at 0.5."""
        if self._model.embedding is None:
            return np.zeros(len(texts))
        found, logits = self.marks(texts)
        return 1 / (1 + np.exp(-np.clip(logits - self._model.thresholds[found], -500, 500)))

    def marks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The language found in each text, and its logit."""
        texts = pc.fill_null(texts, "")
        every = [self._marks(some) for some in runs(texts, _BYTES_AT_ONCE)] or [([], [])]
        found, logits = zip(*every)
        return np.concatenate(found).astype(np.int64), np.concatenate(logits).astype(np.float64)

    def _marks(self, texts: pa.Array) -> tuple[list[int], list[float]]:
        words, ends = [], [0]
        for text in strings(texts):
            words += words_of(text)
            ends.append(len(words))
        told = pa.array(words, pa.large_string()).dictionary_encode()
        del words
        responses, languages = self._of_words(strings(told.dictionary))
        every = told.indices.to_numpy()
        found, logits = [], []
        for first, last in pairwise(ends):
            own = every[first:last]
            found.append(int(languages.take(own, axis=0).sum(axis=0, dtype=np.float64).argmax()))
            logits.append(self._model.logit(responses.take(own, axis=0)))
        return found, logits

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word what the filters make of it, and its languages."""
        buckets, sizes = buckets_of(words)
        begins = np.cumsum(sizes) - sizes
        responses = np.empty((len(words), self._model.filters.shape[1]), np.float32)
        for first in range(0, len(words), _WORDS_AT_ONCE):
            last = first + _WORDS_AT_ONCE
            start, own = begins[first], sizes[first:last]
            flat = buckets[start : start + own.sum()]
            responses[first:last] = np.add.reduceat(self._model.filters[flat], begins[first:last] - start)
        return responses, self._model.by_language[buckets[begins]]
