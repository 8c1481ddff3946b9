"""Documents whose sets of word n-grams are nearly equal, by signature trees.

Equal sets are one class. In an order of all n-grams that puts frequent ones last, two
sets of the wanted likeness share one of their first few n-grams; each n-gram of those beginnings
is the root of a tree over the classes that have it, sorted by size. A node holds the OR of its classes'
bitmaps and their range of sizes, and the trees are gone through in pairs of nodes: a pair is left where
the sizes are too far apart, where even the bits that both have would be too few, or where all its
classes are joined already. What is left are blocks of possible neighbours, usually a class and its near copies.
Only for these are the sets themselves brought together, and the same traversal over exact
bitmaps gives the links. Trees over more than a fixed number of classes are cut in slices, every pair of slices
a tree of its own, so a task holds a bounded number of classes whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored

WORDS = 5
PERCENT = 80
ORDER_BUCKETS = 1 << 20
_ORDER_CHUNKS = 256
_LEAF = 16
_CLASSES_IN_TREE = 1024
_SETS_IN_TREE = 128
_GRAMS_IN_TREE = 1 << 18
_KNOWN_WORDS = 400_000
_LEAST_FILTER_BITS = 1 << 20
_MOST_FILTER_BITS = 1 << 30
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


# --- sets of n-grams ---------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Grams:
    """Sets of hashed word n-grams of texts; hashes of words seen before are kept, up to a fixed number."""

    def __init__(self, words: int):
        self.words = words
        self._known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """The different n-grams as sorted 64-bit hashes; fewer words than n are one gram, none give none."""
        import xxhash

        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII blanks only
        if not words:
            return np.zeros(0, np.uint64)
        known = self._known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        span = min(self.words, len(words))
        grams = np.full(len(words) - span + 1, span, np.uint64)
        for offset in range(span):
            grams = _mixed(grams * _SPREAD + hashes[offset : offset + len(grams)])
        return np.unique(grams)


def bitmap(grams: np.ndarray) -> bytes:
    """Bits of the quarter of all n-grams that a part of their hash selects.

    What a set has in this quarter and another has not, it has not in common with it at all, so the bits bound
    the overlap of whole sets. Half as many bits as the set is large, a power of two.
    """
    width = max(64, 1 << (len(grams) // 2).bit_length())
    bits = np.zeros(width, np.uint8)
    chosen = grams[(grams >> np.uint64(40)) & np.uint64(3) == 0]
    bits[(chosen & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


# --- tables of a fixed size, summed up over all tasks ---------------------------------


def _combined(parts: DataFrame, kind: str, combine: np.ufunc, chunks: int, length: int) -> np.ndarray:
    """Element by element over rows of (chunk, values): one array of chunks * length elements."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, values in zip(batch.column("chunk").to_pylist(), batch.column("values")):
                own = np.frombuffer(values.as_py(), kind)
                held[chunk] = combine(held[chunk], own) if chunk in held else own.copy()
        if held:
            values = pa.array([own.tobytes() for own in held.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), values], ["chunk", "values"])

    whole = np.zeros((chunks, length), kind)
    for row in parts.repartition("chunk").mapInArrow(gather, "chunk int, values binary").collect():
        whole[row["chunk"]] = combine(whole[row["chunk"]], np.frombuffer(bytes(row["values"]), kind))
    return whole.ravel()


def gram_order(texts: DataFrame, words: int) -> np.ndarray:
    """How frequent the n-grams of each bucket are: 0 for usual, then powers of two of the mean.

    Any order gives the same links; this one keeps passages that many documents share
    out of the beginnings. Counts of all documents, a table of ORDER_BUCKETS.
    """
    length = ORDER_BUCKETS // _ORDER_CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = Grams(words), np.zeros(ORDER_BUCKETS, np.uint32)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(counts, _bucket(grams.of(text.as_py())), 1)
        there = [chunk for chunk, own in enumerate(counts.reshape(_ORDER_CHUNKS, length)) if own.any()]
        values = [counts[chunk * length : (chunk + 1) * length].tobytes() for chunk in there]
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(values, pa.binary())], ["chunk", "values"])

    parts = texts.select("text").mapInArrow(count, "chunk int, values binary")
    counts = _combined(parts, "<u4", np.add, _ORDER_CHUNKS, length).astype(np.float64)
    return np.maximum(np.log2(np.maximum(counts, 1) / max(counts.mean(), 1.0)), 0).astype(np.uint8)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - (ORDER_BUCKETS - 1).bit_length())).astype(np.int64)


def _beginning(grams: np.ndarray, order: np.ndarray, percent: int) -> np.ndarray:
    """So many first n-grams that a set of the wanted likeness must share one of its own."""
    count = len(grams) - -(-percent * len(grams) // 100) + 1
    if not len(grams):
        return grams
    rank = np.lexsort((grams, order[_bucket(grams)]))
    return grams[rank[:count]]


# --- signature trees ----------------------------------------------------------------


class _Joined:
    """Which rows are joined already."""

    def __init__(self, rows: int):
        self.parent = np.arange(rows)

    def root(self, row: int) -> int:
        while self.parent[row] != row:
            self.parent[row] = self.parent[self.parent[row]]
            row = int(self.parent[row])
        return row

    def roots(self, first: int, last: int) -> np.ndarray:
        return np.array([self.root(row) for row in range(first, last)])

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def tree_links(bitmaps: np.ndarray, sizes: np.ndarray, spare: np.ndarray, percent: int, joined: _Joined | None = None,
               paired: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join all rows whose likeness may reach the threshold, as few as that takes.

    Rows are sorted by size. ``bitmaps`` are rows of 64-bit words; ``spare`` is how many elements
    of a row have no bit of their own, 0 where bits are exact. Of two rows one at least must be
    ``paired``, if it is given.
    """
    rows = len(sizes)
    joined = joined or _Joined(rows)
    links: list[tuple[int, int]] = []
    edges = list(range(0, rows, _LEAF)) + [rows]
    # levels from the leaves up; a node is (first row, last row) with the OR of its bitmaps
    levels = [list(zip(edges[:-1], edges[1:]))]
    ors = [np.array([np.bitwise_or.reduce(bitmaps[a:b], axis=0) for a, b in levels[0]])]
    while len(levels[-1]) > 1:
        below, held = levels[-1], ors[-1]
        levels.append([(below[i][0], below[min(i + 1, len(below) - 1)][1]) for i in range(0, len(below), 2)])
        ors.append(np.array([np.bitwise_or.reduce(held[i : i + 2], axis=0) for i in range(0, len(below), 2)]))
    stack = [(len(levels) - 1, 0, 0)] if rows > 1 else []
    while stack:
        level, x, y = stack.pop()
        (a, b), (c, d) = levels[level][x], levels[level][y]
        if sizes[b - 1] * 100 < sizes[c] * percent:  # the largest of x against the smallest of y
            continue
        if x != y:
            most = int(np.bitwise_count(ors[level][x] & ors[level][y]).sum()) + int(min(spare[a:b].max(), spare[c:d].max()))
            if most * (100 + percent) < percent * int(sizes[a] + sizes[c]):
                continue
        if level:
            low, end = level - 1, len(levels[level - 1])
            for i in (2 * x, 2 * x + 1):
                for j in (2 * y, 2 * y + 1):
                    if i < end and j < end and i <= j:
                        stack.append((low, i, j))
            continue
        left, right = joined.roots(a, b), joined.roots(c, d)
        if left[0] == right[0] and (left == left[0]).all() and (right == left[0]).all():
            continue
        both = np.bitwise_count(bitmaps[a:b, None, :] & bitmaps[None, c:d, :]).sum(axis=2, dtype=np.int64)
        most = both + np.minimum(spare[a:b, None], spare[None, c:d])
        # overlap / (size + size - overlap) >= percent / 100
        near = most * (100 + percent) >= percent * (sizes[a:b, None] + sizes[None, c:d])
        near &= left[:, None] != right[None, :]
        if paired is not None:
            near &= paired[a:b, None] | paired[None, c:d]
        for i, j in zip(*np.nonzero(near)):
            if a + i < c + j and joined.join(a + int(i), c + int(j)):
                links.append((a + int(i), c + int(j)))
    return links


def possible_links(sizes: np.ndarray, bitmaps: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Links over folded bitmaps of sets of any sizes: all pairs that may be near are joined."""
    joined, links = _Joined(len(sizes)), []
    widths = np.array([8 * len(bits) for bits in bitmaps])
    order = np.argsort(sizes, kind="stable")
    for width in np.unique(widths):
        # near sets are of this width or the next; the wider are folded
        own = order[(widths[order] == width) | (widths[order] == 2 * width)]
        if len(own) < 2 or not (widths[own] == width).any():
            continue
        raw = [np.frombuffer(bitmaps[row], np.uint64) for row in own]
        table = np.array([bits if 64 * len(bits) == width else bits[: len(bits) // 2] | bits[len(bits) // 2 :] for bits in raw])
        spare = sizes[own] - np.bitwise_count(table).sum(axis=1, dtype=np.int64)
        view = _Joined(len(own))
        first: dict[int, int] = {}
        for place, row in enumerate(own):
            view.parent[place] = first.setdefault(joined.root(int(row)), place)
        found = tree_links(table, sizes[own], spare, percent, view, widths[own] == width)
        for a, b in found:
            if joined.join(int(own[a]), int(own[b])):
                links.append((int(own[a]), int(own[b])))
    return links


def exact_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all sets at or over the threshold, each link exact."""
    sizes = np.array([len(own) for own in sets])
    order = np.argsort(sizes, kind="stable")
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.cumsum(sizes) - sizes
    words = -(-(int(local.max()) + 1) // 64)
    table = np.zeros((len(sets), words), np.uint64)
    for place, row in enumerate(order):
        bits = local[bounds[row] : bounds[row] + sizes[row]].astype(np.uint64)
        np.bitwise_or.at(table[place], (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    found = tree_links(table, sizes[order], np.zeros(len(sets), np.int64), percent)
    return [(int(order[a]), int(order[b])) for a, b in found]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[tuple]]:
    """Rows of equal keys, from batches sorted by them; the keys come first in a row."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if held and row[: len(keys)] != held[0][: len(keys)]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _sliced(rows: DataFrame, slices: Column) -> DataFrame:
    """Each row once for every pair of slices its own is in, as columns i and j."""
    own = F.pmod(F.xxhash64("node", F.lit("slice")), slices)
    with_other = rows.withColumn("slices", slices).withColumn("own", own)
    other = with_other.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices").cast("long") - 1)))
    return other.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("slices", "own", "other")


# --- connected components ------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for every node with a link.

    ``links`` has a and b. Neighbours are hooked to the smallest one around, by turns over
    larger and over smaller neighbours, until every node hangs on its component (Kiveris et al. 2014). Links of
    a node are only aggregated, never gathered.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stored(large.where("a <> b").distinct(), "large")
        least = stored(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
        hooked = edges.join(least, "a")
        small = hooked.select(F.col("b").alias("a"), F.col("least").alias("b")).union(hooked.select("a", F.col("least").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "small")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


# --- the join ---------------------------------------------------------------------


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row for each document: its id, n_shingles, component_id.

    A text's words are what stands between ASCII blanks, A-Z lower-cased; its set is its different
    ``words``-grams, of a shorter text the whole sequence. Two documents link when
    100 * intersection >= percent * union. ``component_id`` is the smallest id reachable over links,
    its own for a document without. A null or blank text has no set and no link. A row
    with a null id has no link and a null component_id; rows that repeat an id are in one
    component. An empty table gives no rows. Extra columns are not read. Ids are integers.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is from 50 to 100: bitmaps are compared over twice the size at most")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    order = context.broadcast(gram_order(texts, words))  # ORDER_BUCKETS bytes

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(words)
        for batch in batches:
            sizes, keys, beginnings, bitmaps = [], [], [], []
            for text in batch.column("text"):
                own = grams.of(text.as_py())
                sizes.append(len(own))
                digest = np.array([own.sum(), _mixed(own).sum()], np.uint64)
                keys.append(digest.tobytes().hex())
                beginnings.append(_beginning(own, order.value, percent).view(np.int64))
                bitmaps.append(bitmap(own))
            arrays = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.string())]
            arrays += [pa.array(beginnings, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "size", "key", "beginning", "bitmap"])

    described = stored(
        texts.mapInArrow(describe, "id long, size long, key string, beginning array<long>, bitmap binary"), "described"
    )
    classes = stored(
        described.where("size > 0 AND id IS NOT NULL").groupBy("key", "size").agg(
            F.min("id").alias("node"), F.first("beginning").alias("beginning"), F.first("bitmap").alias("bitmap")
        ),
        "classes",
    )
    blocks = components(_possible(classes, percent))
    links = _exact(texts, classes, blocks, words, percent)
    found = components(links)
    labelled = classes.select("key", F.col("size").alias("class_size"), "node").join(found, "node", "left")
    labelled = stored(labelled.select("key", "class_size", F.coalesce("component", "node").alias("component")), "labelled")
    same = (described["key"] == labelled["key"]) & (described["size"] == labelled["class_size"]) & described["id"].isNotNull()
    result = described.join(labelled, same, "left").select(
        described["id"], F.col("size").alias("n_shingles"), F.coalesce("component", described["id"]).alias("component_id")
    )
    return result.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def drop_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The documents with all columns of the input, of each group only the one with the smallest id.

    Documents without a link stay, as do rows with a null id; rows that repeat the
    id that stays are one document and stay together.
    """
    groups = near_groups(docs, id_col, text_col, words, percent)
    dropped = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("near copy"))
    return docs.join(dropped, docs[id_col] == dropped["near copy"], "left_anti")


def _possible(classes: DataFrame, percent: int) -> DataFrame:
    """Links a, b that join any two classes which may be near, by the trees of their first n-grams."""
    entries = classes.select(F.explode("beginning").alias("gram"), "node", "size")
    counted = entries.groupBy("gram").agg(
        F.count(F.lit(1)).alias("rows"), F.min("size").alias("least"), F.max("size").alias("most")
    )
    pair = (F.col("rows") > 2) | (F.col("least") * 100 >= F.col("most") * percent)
    roots = stored(counted.where((F.col("rows") > 1) & pair).select("gram", "rows"), "roots")
    placed = entries.select("gram", "node").join(roots, "gram")
    sliced = _sliced(placed, F.ceil(F.col("rows") / _CLASSES_IN_TREE))
    trees = stored(sliced.select("gram", "i", "j", "node"), "trees").join(classes.select("node", "size", "bitmap"), "node")
    keys = ["gram", "i", "j"]

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for run in _runs(batches, keys):
            if len(run) < 2:
                continue
            nodes = [row[3] for row in run]
            links = possible_links(np.array([row[4] for row in run]), [row[5] for row in run], percent)
            found.update((max(nodes[a], nodes[b]), min(nodes[a], nodes[b])) for a, b in links)
            if len(found) > 100_000:
                yield _pairs(found)
                found = set()
        if found:
            yield _pairs(found)

    dealt = trees.select(*keys, "node", "size", "bitmap").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(traverse, "a long, b long").distinct()


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _exact(texts: DataFrame, classes: DataFrame, blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """Links a, b of the classes in one block, over their whole sets."""
    members = blocks.join(classes.select("node", "size"), "node")
    members = stored(members.select("node", "size", F.col("component").alias("block")), "members")
    total = members.count()
    wanted = _membership(members.select("node"), total, texts.sparkSession)
    chosen_by = texts.sparkSession.sparkContext.broadcast(wanted)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(words)
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            there = np.flatnonzero(_is_member(ids, chosen_by.value))
            values = [grams.of(batch.column("text")[int(row)].as_py()).tobytes() for row in there]
            yield pa.RecordBatch.from_arrays([pa.array(ids[there], pa.int64()), pa.array(values, pa.binary())], ["id", "grams"])

    sets = texts.where("id IS NOT NULL").mapInArrow(sets_of, "id long, grams binary")
    sizes = members.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("all_grams"))
    slices = F.ceil(F.greatest(F.col("rows") / _SETS_IN_TREE, F.col("all_grams") / _GRAMS_IN_TREE))
    sliced = _sliced(members.join(stored(sizes, "blocks"), "block"), slices).select("block", "i", "j", "node")
    placed = stored(sliced, "placed").join(sets, F.col("node") == F.col("id"))
    keys = ["block", "i", "j"]

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, keys):
            nodes = [row[3] for row in run]
            links = exact_links([np.frombuffer(row[4], np.uint64) for row in run], percent) if len(run) > 1 else []
            if links:
                yield _pairs({(max(nodes[a], nodes[b]), min(nodes[a], nodes[b])) for a, b in links})

    dealt = placed.select(*keys, "node", "grams").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(traverse, "a long, b long")


# --- a filter of bits for the ids that are wanted ----------------------------------------


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(ids.astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _membership(ids: DataFrame, count: int, spark) -> np.ndarray:
    """One bit for the hash of each id; at most _MOST_FILTER_BITS. It may let other ids through."""
    bits = min(_MOST_FILTER_BITS, max(_LEAST_FILTER_BITS, 1 << int(16 * count).bit_length()))
    chunks = bits // _LEAST_FILTER_BITS
    length = _LEAST_FILTER_BITS // 8

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            places = _places(batch.column(0).to_numpy(), bits)
            for chunk in np.unique(places // _LEAST_FILTER_BITS):
                flags = own.setdefault(int(chunk), np.zeros(_LEAST_FILTER_BITS, bool))
                flags[places[places // _LEAST_FILTER_BITS == chunk] % _LEAST_FILTER_BITS] = True
        for chunk, flags in own.items():
            values = pa.array([np.packbits(flags).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), values], ["chunk", "values"])

    return _combined(ids.mapInArrow(mark, "chunk int, values binary"), "u1", np.bitwise_or, chunks, length)


def _is_member(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    places = _places(ids, 8 * len(wanted))
    return (wanted[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 > 0
