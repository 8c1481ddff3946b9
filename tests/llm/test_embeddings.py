"""Whitening and hard negatives: by brute force on odd rows and on whole tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidelog.llm import eigen, hard_negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
SF_DIR = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def single(values):
    return [float(np.float32(value)) for value in values]


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(3)
    rows = [((1 << 53) + 1 + n, single(draw.gauss(0, 0.2) for _ in range(6)), n % 3) for n in range(40)]
    rows += [(n, single(draw.gauss(0.1, 0.1) for _ in range(6)), n % 3) for n in range(0, 400, 10)]
    rows += [(1000 + n, rows[3][1], 1) for n in range(30)]  # copies
    rows += [(7, rows[0][1], 0), (7, rows[0][1], 0), (200, rows[42][1], 2), (None, rows[1][1], 1)]
    rows += [(3000, None, 1), (3001, [0.1, None, 0.1, 0.1, 0.1, 0.1], 1), (3002, [NAN] * 6, 1), (3003, [INF] * 6, 0)]
    rows += [(3004, [], 1), (3100, [0.5, -0.5], 1), (3101, [0.5, 0.25, 0.1], 2), (3200, rows[5][1], None), (3300, [0.0] * 6, 0)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    frame = spark.createDataFrame(odd_rows, SCHEMA).repartition(5)
    for name in ("id", "vector", "component", "n", "rank", "offset", "anchor", "score"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


# --- eigenvalues --------------------------------------------------------------------


def symmetric(size, rank, seed):
    rows = np.random.default_rng(seed).normal(size=(rank, size))
    return rows.T @ rows


@pytest.mark.parametrize(
    "matrix",
    [
        symmetric(64, 200, 1), symmetric(64, 5, 2), symmetric(3, 9, 3), symmetric(2, 5, 4), np.eye(20), np.ones((9, 9)),
        np.diag([3.0, 3, 3, 2, 2, 1, 0, 0]), np.zeros((4, 4)), np.array([[2.5]]), 1e-9 * symmetric(10, 30, 5),
        np.kron(np.eye(6), symmetric(3, 3, 6)), np.diag(np.abs(np.arange(-10, 11.0))) + np.eye(21, k=1) + np.eye(21, k=-1),
    ],
)
def test_leading_eigenvectors(matrix):
    values, vectors = eigen.leading(matrix, 16)
    wanted = np.linalg.eigvalsh(matrix)[::-1][:16]
    scale = np.abs(matrix).max() or 1
    assert np.abs(values - wanted).max() <= 1e-12 * scale
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12


# --- whitening ----------------------------------------------------------------------


def kept(rows, dims):
    return [(i, v) for i, v, _ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def check_whitened(found, rows, dims, components):
    """Against whole-number sums and numpy's eigenvectors."""
    lattice = {}  # an id may have several vectors
    for i, v in rows:
        lattice.setdefault(i, []).append([math.floor(64 * x) + 1_000_000 for x in v])
    distinct = sorted({tuple(math.floor(64 * x) + 1_000_000 for x in v) for _, v in rows})
    n, sums = len(distinct), [sum(column) for column in zip(*distinct)]
    centred = np.array([[(n * x - s) / n for x, s in zip(row, sums)] for row in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(found) == count * len(rows)
    signs = {}
    for row in found:
        k = row["component"] - 1
        fitting = [own for own in lattice[row["vec_id"]] if row["deviation"] == sum((n * x - s) ** 2 for x, s in zip(own, sums))]
        assert row["n"] == n and fitting
        own = fitting[0]
        assert row["identity_error"] <= 1e-9
        assert row["explained"] == pytest.approx(values[k] / np.trace(covariance), rel=1e-9)
        wanted = float(np.array([(n * x - s) / n for x, s in zip(own, sums)]) @ vectors[:, k]) / math.sqrt(values[k])
        if abs(wanted) > 1e-3:
            sign = signs.setdefault(k, math.copysign(1, wanted * row["whitened"]))
            assert row["whitened"] == pytest.approx(sign * wanted, rel=1e-6)
    assert sorted(signs) == list(range(count))


def test_whitening_of_odd_rows(odd, odd_rows):
    model = whitening.fit(odd)
    found = whitening.whiten(odd, model)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(found.collect(), kept(odd_rows, 6), 6, 16)


def test_whitening_of_a_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = entry.queries()["op11_whiten_embeddings"](spark, SF_DIR).collect()
    check_whitened(found, kept(rows, 64), 64, 16)


def test_whitening_of_few_vectors(spark):
    few = [
        [], [(1, None, 0)], [(1, [], 0)], [(1, [0.5, 0.25], 0)], [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 1)],
        [(1, [1e20, 1.0], 0)],  # beyond any exact sum
    ]
    for rows in few:
        frame = spark.createDataFrame(rows, SCHEMA)
        assert whitening.whiten(frame, whitening.fit(frame)).collect() == []
    line = [(n, [float(n), 2.0 * n, 0.0], 0) for n in range(5)]
    frame = spark.createDataFrame(line, SCHEMA)
    found = whitening.whiten(frame, whitening.fit(frame)).collect()
    assert {row["component"] for row in found} == {1}
    check_whitened(found, [(i, v) for i, v, _ in line], 3, 16)


def test_deviation_is_exact_beyond_doubles(spark):
    rows = [(n, [float(n % 3) * 40000, float(n % 5) * 30000], 0) for n in range(15)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    check_whitened(whitening.whiten(frame, whitening.fit(frame)).collect(), [(i, v) for i, v, _ in rows], 2, 16)
    wide = spark.createDataFrame([(1, [4e12], 0), (2, [-4e12], 0)], "vec_id long, embedding array<double>, label int")
    assert {row["deviation"] for row in whitening.whiten(wide, whitening.fit(wide)).collect()} == {None}


# --- hard negatives -----------------------------------------------------------------


def brute_negatives(rows, is_anchor, positives=5, negatives=5, least=80, most=100):
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor, label, vector in usable:
        if not is_anchor(anchor):
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, other)), i, own) for i, own, other in usable)
        near = [(-s, i) for s, i, own in scored if own == label and i != anchor][:positives]
        for score, positive in near:
            band = [(-s, i) for s, i, own in scored if own != label and least * score <= -100 * s <= most * score]
            out += [(anchor, positive, rank, i, score, s) for rank, (s, i) in enumerate(band[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("at_once", [1 << 20, 30])
def test_negatives_of_odd_rows(odd, odd_rows, at_once, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", at_once)  # one block, and many
    found = hard_negatives.mine(odd, F.col("vec_id") % 20 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    wanted = brute_negatives(odd_rows, lambda i: i % 20 == 0)
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 100


def test_negatives_of_a_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    found = entry.queries()["op13_hard_negatives"](spark, SF_DIR).collect()
    assert sorted(map(tuple, found)) == brute_negatives(moved, lambda i: i % 100 == 0)


def test_negatives_of_few_rows(spark):
    everything = F.col("vec_id") >= 0
    for rows in ([], [(1, [0.5], 0)], [(1, [0.5], 0), (2, [0.5], 0)], [(1, [0.5], None), (None, [0.5], 1), (3, None, 1)]):
        assert hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), everything).collect() == []
    rows = [(n, [0.25, 0.5], n % 2) for n in range(60)]  # nothing but ties
    found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), everything).collect()
    assert sorted(map(tuple, found)) == brute_negatives(rows, lambda i: True)


def test_packed_scores_are_exact():
    draw = np.random.default_rng(2)
    for largest, dims in ((3, 4), (150, 64), (1 << 20, 64), ((1 << 24) - 1, 200)):
        candidates = draw.integers(-largest, largest + 1, (300, dims))
        anchors = draw.integers(-largest, largest + 1, (5, dims))
        packed = hard_negatives.Packed(candidates, int(np.abs(anchors).sum(axis=1).max()))
        for anchor in anchors:
            wanted = [sum(int(a) * int(b) for a, b in zip(anchor, other)) for other in candidates]
            assert packed.scores(anchor.tolist()).tolist() == wanted
