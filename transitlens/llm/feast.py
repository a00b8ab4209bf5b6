"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

The spectrum is cut into intervals whose ends lie in gaps; the inertia of a
shifted matrix (an LDL^T factorisation with complete pivoting) says how many
eigenvalues lie below a shift. In each interval a Gauss-Legendre quadrature of
complex shifted solves on a circle projects a subspace onto the interval's
eigenvectors, and Rayleigh-Ritz takes them out of it. The subspace is projected
again until the residuals are at rounding level and as many pairs are found as
the inertia counts promise; if that fails the subspace is made larger, in the
end the whole space.
"""

from __future__ import annotations

import numpy as np

#: Points of the quadrature on the upper half of a circle, and eigenvalues that an interval should hold at most.
POINTS, PER_INTERVAL = 12, 8
ROUNDS = 25
GROWTH = (1 + 17 ** 0.5) / 8


def inertia(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of symmetric ``a`` below ``shift``."""
    a = a - shift * np.eye(len(a))
    below = 0
    while len(a):
        n = len(a)
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, s = divmod(int(off.argmax()), n)
        if diagonal[p] == 0 and off[r, s] == 0:
            return below  # what is left is zero: the shift is an eigenvalue, which isn't below it
        pivots = [p] if diagonal[p] >= GROWTH * off[r, s] else [r, s]
        rest = np.setdiff1d(np.arange(n), pivots)
        block = a[np.ix_(pivots, pivots)]
        if len(pivots) == 1:
            below += int(block[0, 0] < 0)
        else:  # of such a block one eigenvalue is negative and one positive
            below += 1
        side = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return below


def _gap_below(a: np.ndarray, top: float, floor: float, wanted: int, most: int) -> tuple[float, int]:
    """A shift in a gap with ``wanted`` eigenvalues or more between it and ``top``, and their number.

    More than ``most`` only if they lie too close together to be told apart.
    """
    above = len(a) - inertia(a, top)
    low, high = floor, top
    found = len(a) - inertia(a, low) - above
    while found > most and high - low > 1e-13:
        middle = (low + high) / 2
        n = len(a) - inertia(a, middle) - above
        low, high, found = (middle, high, n) if n >= wanted else (low, middle, found)
    # The gap that ``low`` lies in: between the last eigenvalue below it and the first above.
    down, up = [floor, low], [low, top]
    for _ in range(12):
        middle = sum(down) / 2
        same = len(a) - inertia(a, middle) - above == found
        down = [down[0], middle] if same else [middle, down[1]]
        middle = sum(up) / 2
        same = len(a) - inertia(a, middle) - above == found
        up = [middle, up[1]] if same else [up[0], middle]
    return (down[1] + up[0]) / 2, found


def _interval(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``low`` and ``high``."""
    n = len(a)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (1 - nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    turn = radius * np.exp(1j * angles)
    inverses = [np.linalg.inv((centre + t) * np.eye(n) - a) for t in turn]
    size = min(n, max(2 * count, count + 4))
    while True:
        y = np.random.default_rng(size).standard_normal((n, size))
        for _ in range(ROUNDS if size < n else 1):
            if size < n:
                y = sum(w / 2 * (t * g @ y).real for w, t, g in zip(weights, turn, inverses, strict=True))
            u, s, _ = np.linalg.svd(y, full_matrices=False)
            q = u[:, s > s[0] * 1e-14]
            values, turned = np.linalg.eigh(q.T @ a @ q)
            vectors = q @ turned
            inside = (values > low) & (values <= high)
            residual = np.linalg.norm(a @ vectors - vectors * values, axis=0)
            if inside.sum() == count and (size == n or residual[inside].max(initial=0) < 4e-15 * n ** 0.5):
                return values[inside], vectors[:, inside]
            y = vectors
        if size == n:
            raise ArithmeticError(f"{inside.sum()} eigenvalues in ({low}, {high}], inertia says {count}")
        size = min(n, 2 * size)


def largest(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors as columns) of the ``k`` largest eigenvalues, all if fewer.

    A vector's largest entry is positive.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0))
    if n == 0 or scale == 0:
        return np.zeros(min(n, k)), np.eye(n, min(n, k))
    a = (matrix + matrix.T) / (2 * scale)
    floor, top = -1.001, 1.001
    values, vectors, left = [], [], min(n, k)
    while left > 0:
        low, count = _gap_below(a, top, floor, min(left, PER_INTERVAL), max(PER_INTERVAL, min(left, PER_INTERVAL)))
        e, v = _interval(a, low, top, count)
        values.append(e)
        vectors.append(v)
        left, top = left - count, low
    e, v = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-e, kind="stable")[:k]
    v = v[:, order]
    v = v * np.where(np.take_along_axis(v, np.abs(v).argmax(axis=0)[None], 0) < 0, -1, 1)
    return e[order] * scale, v
