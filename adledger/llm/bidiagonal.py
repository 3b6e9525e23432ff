"""Singular values and right singular vectors of a triangular factor by qd transforms.

Householder reflections bring the factor to an upper bidiagonal B; dqds finds the squares
of its singular values to high relative accuracy; twisted factorisations of B'B - lambda
give a vector per value. Every array here is as wide as a row of the data, never as long.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: An entry e of the qd array is dropped below this part of the values beside it.
SMALL = (16 * EPS) ** 2
#: Values closer than this, relative to the larger, form a cluster whose vectors are made orthogonal.
CLUSTER = 1e-3
#: Sweeps allowed per value; dqds takes two or three.
SWEEPS = 200


def reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector u for which x - 2 u (u.x) is a multiple of the first axis; None for zeros beyond it."""
    if len(x) < 2 or not x[1:].any():
        return None
    u = x / np.abs(x).max()
    u[0] += np.copysign(np.linalg.norm(u), u[0])
    return u / np.linalg.norm(u)


def bidiagonalise(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): factor = U B V' with diagonal a >= 0 and superdiagonal b >= 0 of B."""
    work, width = factor.astype(np.float64), factor.shape[1]
    v = np.eye(width)
    for k in range(width):
        u = reflector(work[k:, k])
        if u is not None:
            work[k:, k:] -= 2 * np.outer(u, u @ work[k:, k:])
        if k + 2 < width:
            u = reflector(work[k, k + 1:])
            if u is not None:
                work[k:, k + 1:] -= 2 * np.outer(work[k:, k + 1:] @ u, u)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ u, u)
    a, b = work.diagonal().copy(), work.diagonal(1).copy()
    # signs of rows (free) and columns (turned in V) that leave nothing negative
    column = np.ones(width)
    for k in range(width - 1):
        row = column[k] * (-1.0 if a[k] < 0 else 1.0)
        column[k + 1] = row * (-1.0 if b[k] < 0 else 1.0)
    return np.abs(a), np.abs(b), v * column


def sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One dqds transform; None if the shift was above the smallest value."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = float(q[0]) - shift
    least = d
    for i in range(n - 1):
        if d < 0:
            return None
        top = d + float(e[i])
        if top == 0.0:  # d = e = 0: the pair falls apart here
            new_q[i], new_e[i], d = 0.0, 0.0, float(q[i + 1]) - shift
        else:
            ratio = float(q[i + 1]) / top
            new_q[i], new_e[i] = top, float(e[i]) * ratio
            d = d * ratio - shift
        least = min(least, d)
    if not d >= 0:
        return None
    new_q[-1] = d
    return new_q, new_e, least


def smaller_of_two(p: float, q: float, e: float) -> float:
    """Smaller eigenvalue of the symmetric product of the 2 x 2 bidiagonal with squares p, e, q."""
    total = p + q + e
    root = np.sqrt(max(0.0, (p - q - e) ** 2 + 4 * p * e))
    return 2 * p * q / (total + root) if total + root > 0 else 0.0


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal (a, b), largest first."""
    found: list[float] = []
    open_parts = [(a * a, b * b, 0.0)]
    while open_parts:
        q, e, taken = open_parts.pop()
        sweeps, guess = 0, None
        while len(q) > 1:
            weak = np.flatnonzero(e <= SMALL * np.maximum(taken + np.minimum(q[:-1], q[1:]), 0.0))
            if len(weak):
                cut = int(weak[-1]) + 1
                open_parts.append((q[:cut], e[:cut - 1], taken))
                q, e = q[cut:], e[cut:]
                guess = None
                continue
            if q[0] < q[-1]:  # small values belong at the end
                q, e = q[::-1].copy(), e[::-1].copy()
            shift = smaller_of_two(q[-2], q[-1], e[-1]) if guess is None else min(guess, smaller_of_two(q[-2], q[-1], e[-1]))
            done = None
            for part in (1 - 1e-12, 0.75, 0.25, 0.0):
                done = sweep(q, e, shift * part)
                if done is not None:
                    shift *= part
                    break
            if done is None:  # not reached with shift 0 on finite input
                raise ArithmeticError("qd sweep failed")
            q, e, guess = done
            guess = max(guess, 0.0)
            taken += shift
            sweeps += 1
            if sweeps > SWEEPS * (len(q) + 1):
                raise ArithmeticError("qd sweeps do not converge")
        found.extend(taken + q)
    return np.sort(np.array(found))[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gamma, down, up) of B'B - value: row by row from the top, and from the bottom, as
    differential qd transforms. gamma[k] is the middle pivot if both meet in row k; the vector
    grows from 1 at k by -down[i] towards the top and by -up[i] towards the bottom."""
    n = len(a)
    tiny = EPS * EPS * max(value, float(a.max(initial=0)) ** 2, np.finfo(np.float64).tiny)
    s, p, down, up = np.empty(n), np.empty(n), np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + a[i] * a[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[i] = a[i] * b[i] / pivot
        s[i + 1] = b[i] * b[i] * (s[i] / pivot) - value
    p[-1] = a[-1] * a[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = b[i] * b[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        up[i] = a[i] * b[i] / pivot
        p[i] = a[i] * a[i] * (p[i + 1] / pivot) - value
    return s + p + value, down, up


def vector_at(k: int, down: np.ndarray, up: np.ndarray) -> np.ndarray:
    z = np.zeros(len(down) + 1)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, len(up)):
        z[i + 1] = -up[i] * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def residual(a: np.ndarray, b: np.ndarray, z: np.ndarray, value: float) -> float:
    """Length of B'B z - value z."""
    image = a * z
    image[:-1] += b * z[1:]
    back = a * image
    back[1:] += b * image[:-1]
    return float(np.linalg.norm(back - value * z))


def parts_of(a: np.ndarray, b: np.ndarray) -> list[slice]:
    """Runs of rows between superdiagonal entries that rounding alone can have left."""
    cuts = np.flatnonzero(b <= 8 * EPS * max(a.max(initial=0), b.max(initial=0))) + 1
    edges = [0, *cuts.tolist(), len(a)]
    return [slice(x, y) for x, y in zip(edges, edges[1:])]


def leading(factor: np.ndarray, count: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, right singular vectors as columns) of a square factor, at most
    ``count`` of them, largest first; singular values up to ``floor`` times the largest are left out."""
    top = float(np.abs(factor).max(initial=0))
    width = factor.shape[1]
    if top == 0.0:
        return np.zeros(0), np.zeros((width, 0))
    a, b, v = bidiagonalise(factor / top)
    pieces = [(value, part) for part in parts_of(a, b) for value in dqds(a[part], b[part.start:part.stop - 1])]
    pieces.sort(key=lambda x: -x[0])
    pieces = [(value, part) for value, part in pieces[:count] if value > floor * floor * pieces[0][0]]
    out = np.zeros((width, len(pieces)))
    for j, (value, part) in enumerate(pieces):
        gamma, down, up = twisted(a[part], b[part.start:part.stop - 1], value)
        near = [out[:, i] for i in range(j) if pieces[i][0] - value <= CLUSTER * pieces[i][0]]
        best = np.inf
        for k in np.argsort(np.abs(gamma), kind="stable"):
            z = np.zeros(width)
            z[part] = vector_at(int(k), down, up)
            for _ in range(2):
                for other in near:
                    z -= other * (other @ z)
            size = np.linalg.norm(z)
            if size < 1e-8:
                continue
            z /= size
            off = residual(a, b, z, value)
            if off < best:
                out[:, j], best = z, off
            if not near or best <= 64 * EPS * pieces[0][0]:
                break
    vectors = v @ out
    return np.array([value for value, _ in pieces]) * top * top, vectors
