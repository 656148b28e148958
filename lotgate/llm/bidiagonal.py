"""Singular values and right singular vectors of a small square matrix.

*Householder* reflections bring the matrix to an upper bidiagonal one, *dqds*
finds the singular values of that to high relative accuracy, and *twisted
factorisations* of its shifted square recover the vectors. The matrix has the
width of the data, whatever the number of its rows.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = float(np.finfo(float).eps)
_TINY = 1e-280
CLOSE = 1e-3  # relative gap under which vectors are made orthogonal


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, w): ``matrix = u B w.T`` with B upper bidiagonal (diagonal a,
    superdiagonal b) and orthogonal u, w; u is not formed."""
    m = np.array(matrix, float)
    d = m.shape[1]
    w = np.eye(d)

    def reflector(x):
        v = x.copy()
        norm = np.sqrt(v @ v)
        if norm == 0:
            return None
        v[0] += math.copysign(norm, v[0])
        return v / np.sqrt(v @ v)

    for k in range(d):
        v = reflector(m[k:, k])
        if v is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k + 2 < d and (v := reflector(m[k, k + 1:])) is not None:
            m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ v, v)
            w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def _dqds_step(q: list, e: list, shift: float):
    """One transform with *shift*; (q, e, least d), or None if it is not positive."""
    n = len(q)
    q_new, e_new = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        if d < 0:
            return None
        q_new[i] = d + e[i]
        if q_new[i] <= _TINY:
            if q_new[i] < 0:
                return None
            e_new[i], d = 0.0, q[i + 1] - shift
        else:
            t = q[i + 1] / q_new[i]
            e_new[i] = e[i] * t
            d = d * t - shift
        least = min(least, d)
    if d < 0 or math.isnan(d):
        return None
    q_new[n - 1] = d
    return q_new, e_new, least


def _lower_bound(q: list, e: list) -> float:
    """A positive lower bound of the least eigenvalue: the unshifted transform's
    d are the inverses of the diagonal of the inverse, whose trace bounds it."""
    d, total = q[0], 0.0
    for i in range(len(q)):
        if d <= _TINY:
            return 0.0
        total += 1 / d
        if i + 1 < len(q):
            d = d * q[i + 1] / (d + e[i])
    return (1 - 4 * len(q) * _EPS) / total


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), falling, by
    dqds: shifts are lower bounds of the least one, values leave at the end."""
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if top == 0:
        return np.zeros(len(a))
    found: list[float] = []
    work = [([float(x) ** 2 for x in a / top], [float(x) ** 2 for x in b / top], 0.0)]
    while work:
        q, e, moved = work.pop()
        steps, limit = 0, 100 * len(q)
        while q:
            n = len(q)
            if n == 1:
                found.append(moved + q[0])
                break
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= _EPS * _EPS * (moved + min(q[i], q[i + 1])) or e[i] <= _TINY), None)
            if cut is not None:
                if cut == n - 2:
                    found.append(moved + q[-1])
                    q, e = q[:-1], e[:-1]
                else:
                    work.append((q[cut + 1:], e[cut + 1:], moved))
                    q, e = q[:cut + 1], e[:cut]
                continue
            if steps % 8 == 0 and q[0] < q[-1]:  # small values belong at the end
                q, e = q[::-1], e[::-1]
            steps += 1
            shift = _lower_bound(q, e) if steps > 1 else 0.0
            if moved and shift < _EPS * _EPS * moved:
                shift = 0.0
            for attempt in (shift, shift * (1 - 1e-8), 0.0):
                step = _dqds_step(q, e, attempt)
                if step is not None:
                    q, e, _ = step
                    moved += attempt
                    break
            else:
                raise ArithmeticError("dqds met a value that is not a number")
            if steps > limit:
                raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1] * top * top


class _Twisted:
    """``B.T B - value`` of one unreduced block by its twisted factorisation."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        self.diagonal = a * a - value
        self.diagonal[1:] += b * b
        self.beside = a[:-1] * b
        guard = _EPS * max(float(np.abs(self.diagonal).max()), float(np.abs(self.beside).max(initial=0)), _TINY)
        D, off = a * a, a[:-1] * b
        s, p = np.empty(n), np.empty(n)
        self.down, self.up = np.empty(max(0, n - 1)), np.empty(max(0, n - 1))
        pivot = np.empty(n)
        s[0] = -value
        for i in range(n - 1):  # stationary transform, from the top
            pivot[i] = s[i] + D[i]
            if abs(pivot[i]) < guard * _EPS:
                pivot[i] = -guard * _EPS or -_TINY
            self.down[i] = off[i] / pivot[i]
            s[i + 1] = self.down[i] * (b[i] / a[i]) * s[i] - value
        p[n - 1] = D[n - 1] - value
        for i in range(n - 2, -1, -1):  # progressive transform, from the bottom
            low = b[i] * b[i] + p[i + 1]
            if abs(low) < guard * _EPS:
                low = -guard * _EPS or -_TINY
            self.up[i] = off[i] / low
            p[i] = p[i + 1] * (D[i] / low) - value
        self.gamma = s + p + value
        self.guard = guard

    def vector(self) -> np.ndarray:
        """The null vector as seen from the twist of least residual."""
        n = len(self.gamma)
        twist = int(np.argmin(np.abs(self.gamma)))
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z / np.sqrt(z @ z)

    def improved(self, x: np.ndarray) -> np.ndarray:
        """One step of inverse iteration from *x* (vectors of close values)."""
        n = len(x)
        full = np.diag(self.diagonal + self.guard) + np.diag(self.beside, 1) + np.diag(self.beside, -1)
        y = np.linalg.solve(full, x)
        return y / np.sqrt(y @ y) if np.isfinite(y).all() else x


def leading_directions(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(squares, v): the greatest *count* squared singular values of *matrix*,
    falling, and as columns of v their right singular vectors. Values that are
    zero to working precision are left out."""
    d = matrix.shape[1]
    a, b, w = bidiagonalise(matrix)
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if top == 0:
        return np.zeros(0), np.zeros((d, 0))
    a = np.where(np.abs(a) < _EPS * _EPS * top, _EPS * _EPS * top, a)
    b = np.where(np.abs(b) <= 4 * _EPS * top, 0.0, b)
    pairs = []  # (square, block's first row, end)
    first = 0
    for end in [*(np.flatnonzero(b == 0) + 1).tolist(), d]:
        pairs += [(x, first, end) for x in squared_singular_values(a[first:end], b[first:end - 1]).tolist()]
        first = end
    pairs.sort(key=lambda x: (-x[0], x[1]))
    least = (d * _EPS) ** 2 * pairs[0][0]
    pairs = [x for x in pairs[:count] if x[0] > least]
    vectors, rng = np.zeros((d, len(pairs))), np.random.Generator(np.random.PCG64(12))
    for k, (value, first, end) in enumerate(pairs):
        twisted = _Twisted(a[first:end], b[first:end - 1], value)
        z = twisted.vector()
        close = [j for j in range(k) if pairs[j][1] == first and pairs[j][0] - value <= CLOSE * value]
        if close:
            others = vectors[first:end, close]
            for _ in range(8):
                for _ in range(2):
                    z = z - others @ (others.T @ z)
                    size = np.sqrt(z @ z)
                    z = z / size if size > 1e-6 else rng.standard_normal(end - first)
                if size > 0.99:  # the second pass found nothing left of the others
                    last, z = z, twisted.improved(z)
                    if abs(last @ z) > 1 - 1e-12:
                        break
                else:
                    z = twisted.improved(z)
            for _ in range(2):
                z = z - others @ (others.T @ z)
                z = z / np.sqrt(z @ z)
        vectors[first:end, k] = z
    v = w @ vectors
    # Last bits: orthonormal to working precision.
    for k in range(v.shape[1]):
        for _ in range(2):
            v[:, k] -= v[:, :k] @ (v[:, :k].T @ v[:, k])
            v[:, k] /= np.sqrt(v[:, k] @ v[:, k])
    return np.array([x[0] for x in pairs]), v
