"""Right singular vectors of a small triangular factor by way of its bidiagonal form.

`R = U B V'` by Householder reflections, with B upper bidiagonal. The differential qd
algorithm with shifts (dqds) finds the squares of B's singular values without ever adding
numbers of unlike sign where it matters. For each wanted value a stationary factorisation
from the top and a progressive one from the bottom are joined where their pivot is least;
that twisted factorisation gives the vector by multiplications alone. Vectors of values
that lie close together are made orthogonal by inverse iteration with the same factors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

EPS = float(np.finfo(float).eps)
TOLERANCE = (100 * EPS) ** 2  # of an entry of a qd array that is dropped
CLOSE = 1e-3  # values nearer than this, relatively, share a cluster
MAX_SWEEPS = 100  # per value


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta so that x - beta v (v.x) is zero but for its first entry."""
    v, norm = x.copy(), float(np.linalg.norm(x))
    if norm == 0.0 or not np.any(x[1:]):
        return v, 0.0
    v[0] += norm if x[0] >= 0 else -norm
    return v, 2.0 / float(v @ v)


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Diagonal and superdiagonal of B, and what takes B's right vectors to those of `r`."""
    a, rights = np.array(r, float), []
    for k in range(len(a)):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k + 2 < len(a):
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            rights.append((k + 1, v, beta))

    def back(z: np.ndarray) -> np.ndarray:
        z = z.copy()
        for at, v, beta in reversed(rights):
            z[at:] -= beta * v * (v @ z[at:])
        return z

    return a.diagonal().copy(), a.diagonal(1).copy(), back


def _swept(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float, bool]:
    """One dqds transform; also the least pivot and whether only the last one is negative."""
    d, least, out_q, out_e = q[0] - tau, q[0] - tau, [], []
    for i in range(len(e)):
        top = d + e[i]
        if d < 0 or top <= 0:
            return out_q, out_e, min(least, -1.0), False
        turn = q[i + 1] / top
        out_q.append(top)
        out_e.append(e[i] * turn)
        d = d * turn - tau
        least = min(least, d)
    out_q.append(d)
    return out_q, out_e, least, d < 0 and least == d


def _tail(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows: never below the smallest of all."""
    a, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    square, half = q[-2] * e[-1], (a - c) / 2
    wide = (half * half + square) ** 0.5
    larger = (a + c) / 2 + wide
    return max(0.0, (a * c - square) / larger) if larger > 0 else 0.0


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, largest first."""
    found: list[float] = []
    todo = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    while todo:
        q, e, shift = todo.pop()
        for _ in range(MAX_SWEEPS * max(1, len(q))):
            if not e:
                found.extend(shift + v for v in q)
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= TOLERANCE * (shift + min(q[i], q[i + 1]))), None)
            if cut is None and shift == 0.0 and min(q) == 0.0 and q[-1] == 0.0:
                cut = len(e) - 1 if e[-1] == 0.0 else None
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], shift))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[-1] > 1.5 * q[0]:
                q, e = q[::-1], e[::-1]
            tau = _tail(q, e) if q[-1] > 0 else 0.0
            for attempt in range(4):
                new_q, new_e, least, late = _swept(q, e, tau)
                if least >= 0:
                    break
                tau = 0.0 if attempt == 2 else max(0.0, tau + least) * (1 - 2 * EPS) if late else tau / 4
            q, e, shift = new_q, new_e, shift + tau
        else:
            raise ArithmeticError("singular values were not found")
    return np.sort(np.maximum(found, 0.0))[::-1]


class Twisted:
    """Factors of `L D L' - value` from both ends, joined where the pivot is least."""

    def __init__(self, d: np.ndarray, low: np.ndarray, value: float):
        n, tiny = len(d), EPS * EPS * float(np.max(d))
        self.plus, self.minus = np.empty(n), np.empty(n)
        self.down, self.up = np.empty(n - 1), np.empty(n - 1)
        s, p = np.empty(n), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            self.plus[i] = s[i] + d[i] or tiny
            self.down[i] = d[i] * low[i] / self.plus[i]
            s[i + 1] = self.down[i] * low[i] * s[i] - value
        self.plus[-1] = s[-1] + d[-1] or tiny
        p[-1] = d[-1] - value
        for i in range(n - 2, -1, -1):
            self.minus[i + 1] = d[i] * low[i] ** 2 + p[i + 1] or tiny
            turn = d[i] / self.minus[i + 1]
            self.up[i] = low[i] * turn
            p[i] = p[i + 1] * turn - value
        self.minus[0] = p[0]
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.pivot = gamma[self.at] or tiny

    def _outwards(self, z: np.ndarray, rest: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            z[i] = rest[i] - self.down[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] = rest[i + 1] - self.up[i] * z[i]
        return z / np.linalg.norm(z)

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.plus))
        z[self.at] = 1.0
        return self._outwards(z, np.zeros(len(z)))

    def solved(self, x: np.ndarray) -> np.ndarray:
        """The direction of (L D L' - value)^-1 x."""
        y = x.copy()
        for i in range(self.at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(x) - 1, self.at, -1):
            y[i - 1] -= self.up[i - 1] * y[i]
        rest = np.concatenate([y[: self.at] / self.plus[: self.at], [0.0], y[self.at + 1 :] / self.minus[self.at + 1 :]])
        z = np.zeros(len(x))
        z[self.at] = y[self.at] / self.pivot
        return self._outwards(z, rest)


def _factors(diagonal: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """D and L of B'B; of B'B plus a last-place shift where B has a zero on its diagonal."""
    d = diagonal**2
    if np.all(d > 0):
        return d, above / diagonal[:-1], 0.0
    t, off = d.copy(), diagonal[:-1] * above
    t[1:] += above**2
    shift = EPS * float(np.max(t))
    low = np.empty(len(off))
    d = np.empty(len(t))
    d[0] = t[0] + shift
    for i in range(len(off)):
        low[i] = off[i] / d[i]
        d[i + 1] = max(t[i + 1] + shift - low[i] * off[i], shift * EPS)
    return d, low, shift


def _vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Unit vectors of an unreduced B'B for its largest `values`."""
    if len(diagonal) == 1:
        return [np.ones(1) for _ in values]
    d, low, shift = _factors(diagonal, above)
    out: list[np.ndarray] = []
    for i, value in enumerate(values):
        twisted = Twisted(d, low, value + shift)
        near = [out[j] for j in range(i) if values[j] - value <= CLOSE * values[j]]
        z = twisted.vector()
        for attempt in range(6):
            clean = z.copy()
            for _ in range(2):
                for other in near:
                    clean -= (other @ clean) * other
            norm = np.linalg.norm(clean)
            if norm > 0.5 and attempt >= min(1, len(near)):
                break
            if norm <= 0.01:
                clean = np.random.default_rng(attempt).standard_normal(len(z))
                for other in near:
                    clean -= (other @ clean) * other
            z = twisted.solved(clean / np.linalg.norm(clean))
        out.append(clean / np.linalg.norm(clean))
    return out


def leading(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of a square `r`, and right vectors of the first `most`.

    Falling values; each column of the second array is one unit vector.
    """
    size = float(np.max(np.abs(r), initial=0.0))
    if size == 0.0:
        return np.zeros(len(r)), np.zeros((len(r), 0))
    diagonal, above, back = bidiagonalised(r / size)
    above[np.abs(above) <= EPS * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:]))] = 0.0
    ends = [*(np.flatnonzero(above == 0.0) + 1).tolist(), len(diagonal)]
    blocks, start = [], 0
    for end in ends:
        blocks.append((start, end, dqds(diagonal[start:end], above[start : end - 1])))
        start = end
    ranked = sorted(((-v, i, j) for i, (_, _, values) in enumerate(blocks) for j, v in enumerate(values)))
    wanted = [max((j + 1 for _, i, j in ranked[:most] if i == k), default=0) for k in range(len(blocks))]
    made = [
        _vectors(diagonal[start:end], above[start : end - 1], values[:n])
        for (start, end, values), n in zip(blocks, wanted)
    ]
    columns = []
    for _, i, j in ranked[:most]:
        z = np.zeros(len(r))
        z[blocks[i][0] : blocks[i][1]] = made[i][j]
        z = back(z)
        columns.append(z / np.linalg.norm(z))
    return np.array([-v for v, _, _ in ranked]) * size * size, np.array(columns).T
