"""Best-fit packing of token sequences by exact complements.

Pieces are tokenised where they are read. Only how many pieces there are of each length, a
table of at most ``limit`` rows, goes to the driver, which plans on these counts: for
each length it looks up the gap it leaves among single lengths, sums of two and sums of
three, and takes the combination as often as the counts allow; what no combination fills
goes by best fit. The plan says for each length which ranks go to which sequences; its
size depends on the number of lengths, not of documents. Ranks come from
counts by reading task, so no window ever holds the pieces of a frequent length.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import runs, stored, strings

LIMIT = 2048
END_ID = 0
_BYTES_AT_ONCE = 4 << 20  # of texts that are looked at together, beside the first
_KNOWN_WORDS = 200_000  # in each of two generations
# ASCII marks that are never joined to letters or digits by the tokenizer's split; an
# apostrophe may be.
_MARKS = ".,;:!?()\"-|*#%&$"
_LATIN_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# Byte-level tokenizers write these bytes as characters beyond Latin-1, the others as what they are there.
_UNPRINTED = [byte for byte in range(256) if byte < 33 or 127 <= byte < 161 or byte == 173]
_BYTE_LEVEL = {byte: 256 + n for n, byte in enumerate(_UNPRINTED)}


class ChunkTokens:
    """Token ids of texts, put together from their chunks between blanks.

    For tokenizers that drop white space and never join tokens over it. Arrow tells the chunks of some texts apart, so that
    each is looked up once for all of them. Ids of words seen before are kept, up to a fixed number.
    """

    def __init__(self, path: str):
        # a task has one core; the library's threads only wait for each other there
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._words: dict[str, bytes] = {}
        self._older_words: dict[str, bytes] = {}
        alphabet = "".join(filter(_LATIN_WORD.fullmatch, map(chr, range(256))))
        # where letters of Latin-1 reach the model small and byte by byte, a word of such letters needs nothing else
        self._plain = self._of_letters(alphabet) == self._of_any([alphabet])[0]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where those of each text begin, with the end of all."""
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        ids, sizes = self._chunks(chunks.dictionary)
        which = chunks.indices.to_numpy()
        ends = np.cumsum(np.concatenate([[0], sizes[which]]))
        begins = np.cumsum(np.concatenate([[0], pc.list_value_length(split).to_numpy()]))
        return _gathered(ids, sizes, which), ends[begins]

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some chunks, one after the other, and how many each has.

        Marks at the end of a word are tokens of their own, and ASCII has one lower case.
        """
        bare = pc.ascii_rtrim(chunks, characters=_MARKS)
        cut = pc.and_(pc.utf8_is_alnum(bare), pc.not_equal(bare, chunks))
        words = pc.if_else(cut, bare, chunks)
        words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        lengths = pc.utf8_length(bare.filter(cut)).to_numpy().tolist()
        marks = [chunk[length:] for chunk, length in zip(strings(chunks.filter(cut)), lengths)]
        parts = pa.concat_arrays([words, pa.array(marks, words.type)]).dictionary_encode()
        known = self._known(strings(parts.dictionary))
        part_sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which, marked = parts.indices.to_numpy(), np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        own, after = which[: len(chunks)], which[len(chunks):]
        sizes = part_sizes[own]
        sizes[marked] += part_sizes[after]
        ids = np.frombuffer(b"".join(known), "<u4")
        return _gathered(ids, part_sizes, np.insert(own, marked + 1, after)), sizes

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        if len(self._words) > _KNOWN_WORDS:  # words that come up again move on to the next generation
            self._words, self._older_words = {}, self._words
        known, older, others = self._words, self._older_words, []
        for word in words:
            if word in known:
                continue
            if word in older:
                known[word] = older[word]
            elif self._plain and _LATIN_WORD.fullmatch(word):
                known[word] = self._of_letters(word)
            else:
                others.append(word)
        known.update(zip(others, self._of_any(others)))
        return [known[word] for word in words]

    def _of_letters(self, word: str) -> bytes:
        letters = word.lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTE_LEVEL)
        ids = [token.id for token in self._model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _of_any(self, words: list[str]) -> list[bytes]:
        found = [encoding.ids for encoding in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in found]


def _gathered(values: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``values``, one after the other; run n has ``sizes[n]`` values and follows run n - 1."""
    own, begins = sizes[which], np.cumsum(sizes) - sizes
    places = np.repeat(begins[which] - (np.cumsum(own) - own), own)
    places += np.arange(len(places))
    return values[places]


_loaded: dict[str, ChunkTokens] = {}


def pieces(docs: DataFrame, path: str, limit: int, end_id: int, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """The pieces of each document, with the task that made them and their rank there by length."""
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = f"id {id_type}, piece int, start long, length long, ids_crc32 long, task int, place long"
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = ChunkTokens(path)
        tokens, task, seen = _loaded[path], TaskContext.get().partitionId(), Counter()
        for batch in batches:
            done = 0
            for texts in runs(pc.fill_null(batch.column(1), ""), _BYTES_AT_ONCE):
                some = batch.slice(done, len(texts))
                done += len(texts)
                encoded, begins = tokens.encode_all(texts)
                owners, rows, ids = [], [], []
                for owner, (begin, upto) in enumerate(pairwise(begins.tolist())):
                    own = encoded[begin:upto].tobytes() + end
                    for piece, at in enumerate(range(0, len(own), 4 * limit)):
                        cut_ids = own[at : at + 4 * limit]
                        length = len(cut_ids) // 4
                        owners.append(owner)
                        rows.append((piece, at // 4, length, zlib.crc32(cut_ids), task, seen[length]))
                        seen[length] += 1
                        if keep_ids:
                            ids.append(np.frombuffer(cut_ids, "<u4").astype("int32"))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = ["piece", "start", "length", "ids_crc32", "task", "place"]
                arrays = [some.column(0).take(pa.array(owners, pa.int64()))]
                arrays += [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                if keep_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, ["id", *names, *(["ids"] if keep_ids else [])])

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(cut, columns + (", ids array<int>" if keep_ids else ""))


def plan(counts: np.ndarray, limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths, each with how many sequences have it; ``counts[n]`` pieces are n long.

    Exact combinations of more pieces use up short ones, which may cost more later than
    they save, so the plan is made for combinations up to four, three and two pieces and the
    one with the fewest sequences is taken.
    """
    plans = [_plan(counts, limit, most) for most in (4, 3, 2)]
    return min(plans, key=lambda found: sum(times for _, times in found))


def _plan(counts: np.ndarray, limit: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    left = counts.astype(np.int64).copy()
    done: list[tuple[tuple[int, ...], int]] = [((limit,), int(left[limit]))] if left[limit] else []
    left[limit] = 0
    for find in (_single, _pair, _triple)[: most - 1]:
        there = left > 0
        pair_sums = _pair_sums(there)
        for length in range(limit - 1, 0, -1):
            while left[length]:
                filling = find(length, limit - length, left, there, pair_sums)
                if filling is None:
                    break
                need = Counter((length, *filling))
                times = min(int(left[n]) // k for n, k in need.items())
                done.append(((length, *filling), times))
                for n, k in need.items():
                    left[n] -= k * times
                if any(left[n] == 0 for n in need):
                    there = left > 0
                    pair_sums = _pair_sums(there)
    return done + _best_fit(left, limit)


def _pair_sums(there: np.ndarray) -> np.ndarray:
    """Which sums two of the lengths that are there have."""
    ones = there.astype(np.float32)
    return np.convolve(ones, ones)[: len(there)] > 0.5


def _spare(left: np.ndarray, *lengths: int) -> bool:
    """Whether there are enough pieces for all of these at once."""
    return all(left[n] >= k for n, k in Counter(lengths).items())


def _single(length: int, gap: int, left, there, pair_sums) -> tuple[int, ...] | None:
    return (gap,) if there[gap] and _spare(left, length, gap) else None


def _pair(length: int, gap: int, left, there, pair_sums) -> tuple[int, ...] | None:
    """Two lengths that fill the gap, the longest first."""
    below = np.flatnonzero(there[:gap])[::-1]
    for a in below[there[gap - below]].tolist() if pair_sums[gap] else ():
        if _spare(left, length, a, gap - a):
            return (a, gap - a)
    return None


def _triple(length: int, gap: int, left, there, pair_sums) -> tuple[int, ...] | None:
    """Three lengths that fill the gap, the longest first."""
    below = np.flatnonzero(there[:gap])[::-1]
    for a in below[pair_sums[gap - below]].tolist():
        rest = gap - a
        lower = np.flatnonzero(there[:rest])[::-1]
        for b in lower[there[rest - lower]].tolist():
            if _spare(left, length, a, b, rest - b):
                return (a, b, rest - b)
    return None


def _best_fit(left: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """The rest, longest first, each into the smallest gap that takes it."""
    gaps: dict[int, Counter] = {}
    for length in range(limit - 1, 0, -1):
        count = int(left[length])
        while count:
            gap = min((g for g in gaps if g >= length), default=None)
            if gap is None:
                each = min(limit // length, count)
                used, taken = (length,) * each, count // each
                gaps.setdefault(limit - length * each, Counter())[used] += taken
                count -= taken * each
                continue
            used, open_bins = next(iter(gaps[gap].items()))
            taken = min(count, open_bins)
            gaps[gap][used] -= taken
            if not gaps[gap][used]:
                del gaps[gap][used]
                if not gaps[gap]:
                    del gaps[gap]
            gaps.setdefault(gap - length, Counter())[(*used, length)] += taken
            count -= taken
    return [(used, times) for bins in gaps.values() for used, times in bins.items()]


def slots(combinations: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks, and the sequence and offset of each first rank."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for lengths, times in combinations:
        offset = 0
        for length in lengths:
            found.setdefault(length, []).append((ranks[length], sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    return {length: tuple(np.array(column, np.int64) for column in zip(*rows)) for length, rows in found.items()}


def pack(
    docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    A document is its token ids and ``end_id``; only longer ones are cut, into pieces of
    ``limit`` tokens, the last of them shorter. ``tokenizer`` is the path of the
    vocabulary file. A null or empty text is the end id alone. Rows that repeat an id
    are packed one by one. An empty table gives no rows. Extra columns are not read.
    """
    made = stored(pieces(docs, tokenizer, limit, end_id, id_col, text_col, keep_ids), "pieces")
    by_task = made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("count"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = stored(by_task.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))), "lengths")
    counts = np.zeros(limit + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("count").alias("count")).collect():
        counts[row["length"]] = row["count"]
    where = slots(plan(counts, limit))
    ranked = made.join(by_task.drop("count"), ["task", "length"]).select(
        *[made[c] for c in made.columns if c not in ("task", "place")], (F.col("place") + F.col("before")).alias("rank")
    )
    fields = [f"{field.name} {field.dataType.simpleString()}" for field in ranked.schema if field.name != "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(lengths, kind="stable")
            values, firsts = np.unique(lengths[order], return_index=True)
            for value, own in zip(values, np.split(order, firsts[1:])):
                first, sequences, offsets = where[int(value)]
                at = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = sequences[at] + rank[own] - first[at]
                offset[own] = offsets[at]
            kept = batch.select([name for name in batch.schema.names if name != "rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"]
            )

    placed = ranked.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))
    return placed.withColumnRenamed("id", id_col)
