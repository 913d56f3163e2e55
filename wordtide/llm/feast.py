"""Eigenpairs of a symmetric matrix by contour integration.

A slice of the spectrum is enclosed by a circle. The integral of the resolvent over it is the projector onto the
eigenvectors inside; a quadrature of it costs one complex-shifted solve per node. Rayleigh-Ritz on the projected block
gives the pairs, and the projection is repeated until their residuals are at rounding level. How many eigenvalues lie in
a slice is known beforehand from inertia counts, and at the end the count at every value found shows that none is missing.
"""

from __future__ import annotations

import numpy as np

NODES = 16
# Eigenvalues of one slice, unless they lie closer together than ``CLOSE`` of the spectrum's width.
SLICE = 8
CLOSE = 1e-9
ROUNDS = 40
EXACT = 1e-13


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: the positive pivots of matrix - shift, by Sylvester's law.

    Pivots of one or two rows are chosen by size over all that is left, so the factors stay bounded.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive, k, n = 0, 0, len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        rest = np.abs(a[k:, k:])
        p = int(np.argmax(np.diag(rest)))
        largest = rest[p, p]
        np.fill_diagonal(rest, 0)
        i, j = np.unravel_index(int(np.argmax(rest)), rest.shape)
        if largest == 0 and rest[i, j] == 0:
            break
        if largest >= 0.64 * rest[i, j]:
            swap(k, k + p)
            pivot = a[k, k]
            positive += pivot > 0
            row = a[k, k + 1 :].copy()
            a[k + 1 :, k + 1 :] -= np.outer(row, row / pivot)
            k += 1
        else:
            low, high = sorted((k + int(i), k + int(j)))
            swap(k, low)
            swap(k + 1, high)
            # A block whose diagonal is small beside its corner has one eigenvalue of each sign.
            positive += 1
            rows = a[k : k + 2, k + 2 :].copy()
            a[k + 2 :, k + 2 :] -= rows.T @ np.linalg.solve(a[k : k + 2, k : k + 2], rows)
            k += 2
    return int(positive)


def slices(matrix: np.ndarray, top: int) -> list[tuple[float, float, int]]:
    """Intervals from the top down that hold the ``top`` greatest eigenvalues, with the number in each."""
    reach = np.abs(matrix).sum(axis=1)
    low, high = float((np.diag(matrix) - reach).min()), float(reach.max())
    least = CLOSE * (high - low)
    low, high = low - least, high + least
    found, open_ = [], [(low, high, len(matrix), 0)]
    while open_:
        a, b, above_a, above_b = open_.pop()
        if above_a == above_b or above_b >= top:
            continue
        if above_a - above_b <= SLICE or b - a <= least:
            found.append((a, b, above_a - above_b))
            continue
        middle = (a + b) / 2
        above = count_above(matrix, middle)
        open_ += [(a, middle, above_a, above), (middle, b, above, above_b)]
    return found


def project(matrix: np.ndarray, block: np.ndarray, a: float, b: float) -> np.ndarray:
    """The block's projection onto the eigenvectors with values in (a, b), by Gauss-Legendre nodes on a half circle."""
    centre, radius = (a + b) / 2, (b - a) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(block)
    for node, weight in zip(nodes, weights):
        turn = np.exp(0.5j * np.pi * (node + 1))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, block)
        out += (0.5 * weight * radius * turn * solved).real
    return out


def ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz on the block's span, greatest value first."""
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    basis = left[:, size > 1e-10 * size[0]] if len(size) and size[0] > 0 else left[:, :0]
    values, small = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], basis @ small[:, ::-1]


def slice_pairs(matrix: np.ndarray, a: float, b: float, number: int, scale: float) -> np.ndarray:
    """The ``number`` eigenvectors with values in (a, b)."""
    d, rng = len(matrix), np.random.default_rng(number)
    width = min(d, max(number + 4, number * 3 // 2))
    near = 1e-12 * scale
    while True:
        block = rng.standard_normal((d, width))
        for _ in range(ROUNDS):
            values, vectors = ritz(matrix, project(matrix, block, a, b))
            inside = (values > a - near) & (values <= b + near)
            wrong = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
            if (inside & (wrong <= EXACT * scale * np.sqrt(d))).sum() >= number:
                # One projection more takes them from there to rounding level.
                return ritz(matrix, project(matrix, vectors[:, inside], a, b))[1]
            block = vectors
        if width == d:
            return vectors[:, inside]
        width = min(d, 2 * width)


def greatest_pairs(matrix: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` greatest eigenvalues, falling, and their orthonormal eigenvectors as columns.

    Fails if an inertia count contradicts the values.
    """
    scale = float(np.abs(matrix).max()) if matrix.size else 0.0
    if scale == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    unit = matrix / scale
    parts = [slice_pairs(unit, a, b, number, 1.0 * len(unit)) for a, b, number in slices(unit, top)]
    # Once more over all slices, so that vectors of neighbouring slices are orthogonal as well.
    values, vectors = ritz(unit, np.concatenate(parts, axis=1))
    values, vectors = values[:top], vectors[:, :top]
    slack = 1e-11 * len(unit)
    for i, value in enumerate(values):
        if count_above(unit, value - slack) < i + 1 or count_above(unit, value + slack) > i:
            raise ArithmeticError(f"eigenvalue {i + 1} does not agree with the inertia count")
    if len(values) < min(top, len(unit)):
        raise ArithmeticError(f"{len(values)} of {min(top, len(unit))} eigenvalues found")
    return values * scale, vectors
