"""Leading eigenvalues and eigenvectors of one symmetric matrix, on the driver."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
# Eigenvalues nearer than this share of the matrix's norm are made orthogonal to each other.
_CLUSTER = 1e-3
_ROUNDS = 6


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    The matrix is made tridiagonal by Householder reflections; its eigenvalues are found by
    bisection on Sturm counts, its eigenvectors by inverse iteration, and turned back.
    """
    size = len(matrix)
    count = min(count, size)
    largest = float(np.abs(matrix).max()) if size else 0.0
    if not count or largest == 0:
        return np.zeros(count), np.eye(size)[:, :count]
    diagonal, beside, turned = tridiagonal(matrix / largest)
    values = bisected(diagonal, beside, count)
    vectors = turned @ inverse_iterated(diagonal, beside, values)
    vectors /= np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(count)])
    return values * largest, vectors * signs


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, the numbers beside it, and the orthogonal Q with ``matrix = Q T Q'``."""
    rest, size = np.array(matrix, np.float64), len(matrix)
    turned = np.eye(size)
    for step in range(size - 2):
        column = rest[step + 1 :, step]
        length = np.linalg.norm(column)
        if np.linalg.norm(column[1:]) == 0:
            continue
        mirror = column.copy()
        mirror[0] += np.copysign(length, column[0])
        mirror /= np.linalg.norm(mirror)
        rest[step + 1, step] = rest[step, step + 1] = -np.copysign(length, column[0])
        rest[step + 2 :, step] = rest[step, step + 2 :] = 0
        block = rest[step + 1 :, step + 1 :]
        image = block @ mirror
        image -= (mirror @ image) * mirror
        block -= 2 * (np.outer(mirror, image) + np.outer(image, mirror))
        turned[:, step + 1 :] -= 2 * np.outer(turned[:, step + 1 :] @ mirror, mirror)
    return rest.diagonal().copy(), rest.diagonal(-1).copy(), turned


def below(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues are smaller than each shift: the signs of the Sturm sequence."""
    least = _EPS**2
    squared = beside**2
    ratio = diagonal[0] - shifts
    counts = (ratio < 0).astype(np.int64)
    for place in range(1, len(diagonal)):
        ratio = np.where(np.abs(ratio) < least, -least, ratio)
        ratio = diagonal[place] - shifts - squared[place - 1] / ratio
        counts += ratio < 0
    return counts


def bisected(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, all bisected at once from Gershgorin's bounds."""
    size = len(diagonal)
    around = np.zeros(size)
    around[:-1] += np.abs(beside)
    around[1:] += np.abs(beside)
    norm = float((np.abs(diagonal) + around).max())
    margin = 4 * _EPS * norm
    low = np.full(count, (diagonal - around).min() - margin)
    high = np.full(count, (diagonal + around).max() + margin)
    wanted = size - np.arange(count)  # that many are below a shift above the eigenvalue
    while True:
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= _EPS * norm / 4)).all():
            return middle
        above = below(diagonal, beside, middle) >= wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)


def inverse_iterated(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of a tridiagonal matrix; those of near eigenvalues are kept orthogonal."""
    size = len(diagonal)
    norm = float(np.abs(diagonal).max() + 2 * (np.abs(beside).max() if size > 1 else 0)) or 1.0
    draw = np.random.default_rng(11)
    vectors = np.zeros((size, len(values)))
    first, shift = 0, 0.0
    for place, value in enumerate(values.tolist()):
        if place and values[place - 1] - value > _CLUSTER * norm:
            first = place
        # equal eigenvalues get slightly different shifts, and so different vectors
        shift = min(value, shift - 10 * _EPS * norm) if place > first else value
        solve = factorised(diagonal - shift, beside, norm * _EPS)
        vector = draw.uniform(-1, 1, size)
        for _ in range(_ROUNDS):
            vector = solve(vector / np.abs(vector).max())
            for _ in range(2):
                earlier = vectors[:, first:place]
                vector -= earlier @ (earlier.T @ vector)
            vector /= np.linalg.norm(vector)
        vectors[:, place] = vector
    return vectors


def factorised(diagonal: np.ndarray, beside: np.ndarray, least: float):
    """A solver of the tridiagonal system, by elimination with row exchanges; tiny pivots become ``least``."""
    size = len(diagonal)
    pivot, above, second = diagonal.tolist(), beside.tolist() + [0.0], [0.0] * size
    under = beside.tolist()
    factor, swapped = [0.0] * size, [False] * size
    for row in range(size - 1):
        if abs(under[row]) > abs(pivot[row]):
            swapped[row] = True
            factor[row] = pivot[row] / under[row]
            kept = above[row]
            pivot[row], above[row] = under[row], pivot[row + 1]
            pivot[row + 1] = kept - factor[row] * above[row]
            if row + 2 < size:
                second[row], above[row + 1] = above[row + 1], -factor[row] * above[row + 1]
        else:
            pivot[row] = pivot[row] if abs(pivot[row]) >= least else least
            factor[row] = under[row] / pivot[row]
            pivot[row + 1] -= factor[row] * above[row]
    pivot[-1] = pivot[-1] if abs(pivot[-1]) >= least else least

    def solve(right: np.ndarray) -> np.ndarray:
        x = right.tolist()
        for row in range(size - 1):
            if swapped[row]:
                x[row], x[row + 1] = x[row + 1], x[row]
            x[row + 1] -= factor[row] * x[row]
        for row in range(size - 1, -1, -1):
            rest = x[row]
            if row + 1 < size:
                rest -= above[row] * x[row + 1]
            if row + 2 < size:
                rest -= second[row] * x[row + 2]
            x[row] = rest / pivot[row]
        return np.array(x)

    return solve
