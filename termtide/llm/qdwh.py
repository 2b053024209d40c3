"""Eigenvectors of a symmetric matrix by spectral divide and conquer with QDWH.

The polar factor U of A - shift has eigenvalue 1 where A's lies above the shift and -1 where it
lies below, so (U + I) / 2 projects on the invariant subspace above. Orthonormal bases of that
space and of its complement turn A into two smaller symmetric blocks, which are split again until
they are numbers or multiples of the identity.
"""

from __future__ import annotations

import math

import numpy as np

EPSILON = np.finfo(float).eps
MOST_ITERATIONS = 40


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of a square matrix, by dynamically weighted Halley iteration in QR form.

    `low` bounds the smallest singular value of the iterate from below; the weights depend on it
    alone and make the iteration converge in about six steps from the least positive bound.
    """
    size = len(a)
    norm = np.linalg.norm(a)
    if norm == 0:
        return np.eye(size)
    x = a / norm
    low = _least_singular(x)
    for _ in range(MOST_ITERATIONS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        s = math.sqrt(1 + d)
        weight = s + 0.5 * math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * s)))
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(c) * x, np.eye(size)]))
        moved = (b / c) * x + (weight - b / c) / math.sqrt(c) * (q[:size] @ q[size:].T)
        change = np.linalg.norm(moved - x)
        x = moved
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        if change < (5 * EPSILON) ** (1 / 3) and abs(1 - low) < 5 * EPSILON:
            break
    return x


def _least_singular(x: np.ndarray) -> float:
    """A positive lower bound of the least singular value, as good as rounding allows."""
    try:
        norm = np.linalg.norm(np.linalg.inv(x), 1)
    except np.linalg.LinAlgError:
        return EPSILON
    return max(EPSILON, 0.9 / (norm * math.sqrt(len(x)))) if np.isfinite(norm) else EPSILON


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns, the first `rank` of which span the projector's range.

    A first QR factorization of the projector's columns, largest first, finds the range; a second
    one of the projector times that basis (a step of subspace iteration) removes its rounding.
    """
    order = np.argsort(-np.linalg.norm(projector, axis=0), kind="stable")
    chosen, work = [], projector[:, order].copy()
    # Gram-Schmidt with pivoting, twice per column.
    for _ in range(rank):
        column = int(np.argmax(np.einsum("ij,ij->j", work, work)))
        q = work[:, column].copy()
        for _ in range(2):
            for earlier in chosen:
                q -= earlier * (earlier @ q)
        q /= np.linalg.norm(q)
        chosen.append(q)
        work -= np.outer(q, q @ work)
    first = np.stack(chosen, axis=1)
    full, _ = np.linalg.qr(projector @ first, mode="complete")
    return full


def _shifts(a: np.ndarray):
    """Points to split at: all lie between the least and the greatest eigenvalue."""
    diagonal = np.diag(a)
    mean, spread = diagonal.mean(), np.linalg.norm(a - diagonal.mean() * np.eye(len(a)))
    spread /= math.sqrt(len(a))
    yield float(np.median(diagonal))
    yield float(mean)
    # The eigenvalues' mean and deviation; other fractions in case one of them is an eigenvalue.
    for part in range(1, 2 * len(a) + 4):
        fraction = part / (2 * len(a) + 4)
        yield float(mean + spread * fraction)
        yield float(mean - spread * fraction)


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int]:
    """Orthonormal basis whose first columns span the space above a shift, and their number.

    Of all shifts the first is taken that leaves no more than rounding between both blocks.
    """
    best = None
    for shift in _shifts(a):
        u = polar_factor(a - shift * np.eye(len(a)))
        u = (u + u.T) / 2
        rank = round((np.trace(u) + len(a)) / 2)
        if not 0 < rank < len(a):
            continue
        basis = _basis((u + np.eye(len(a))) / 2, rank)
        left = np.linalg.norm(basis[:, rank:].T @ a @ basis[:, :rank])
        if best is None or left < best[0]:
            best = (left, basis, rank)
        if left <= 10 * len(a) * EPSILON * scale:
            break
    if best is None:
        raise ArithmeticError("no shift splits the matrix")
    return best[1], best[2]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the greatest down, and unit eigenvectors as columns in that order."""
    a = np.asarray(a, float)
    a = (a + a.T) / 2
    scale = float(np.linalg.norm(a))
    values, vectors = [], []
    waiting = [(a, np.eye(len(a)))]
    while waiting:
        block, basis = waiting.pop()
        size = len(block)
        middle = np.trace(block) / size if size else 0.0
        rest = np.linalg.norm(block - middle * np.eye(size))
        if size == 1 or rest <= EPSILON * scale:
            values += np.diag(block).tolist()
            vectors += list(basis.T)
            continue
        own, rank = _split(block, scale)
        for part in (slice(rank, None), slice(None, rank)):
            # Bases are made from the whole matrix, so that rounding does not add up by level.
            columns = np.linalg.qr(basis @ own[:, part])[0]
            smaller = columns.T @ a @ columns
            waiting.append(((smaller + smaller.T) / 2, columns))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).T.reshape(len(a), -1)[:, order]
