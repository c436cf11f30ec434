"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of the LDLᵀ factors of a shifted matrix counts the eigenvalues above the shift.
Bisection by such counts isolates each leading eigenvalue, Rayleigh quotient iteration takes it to
double precision inside its interval, and counts between the results certify their numbering.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17**0.5) / 8  # bounds the growth of the factors (Bunch and Kaufman)
_EPS = np.finfo(np.float64).eps


class Factors:
    """LDLᵀ of a symmetric matrix with symmetric pivoting, blocks of one or two in D."""

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, np.float64)
        n = len(a)
        self.order, self.blocks, k = np.arange(n), [], 0
        self.positive = 0
        self.lower = np.eye(n)
        while k < n:
            size, swap = self._pivot(a, k)
            if swap is not None:
                at = k + size - 1
                for m in (a, a.T):
                    m[[at, swap], k:] = m[[swap, at], k:]
                self.lower[[at, swap], :k] = self.lower[[swap, at], :k]
                self.order[[at, swap]] = self.order[[swap, at]]
            end = k + size
            d = a[k:end, k:end].copy()
            if size == 1:
                self.positive += int(d[0, 0] > 0)
                part = a[end:, k:end] / d[0, 0] if d[0, 0] else np.zeros((n - end, 1))
            else:
                det = d[0, 0] * d[1, 1] - d[0, 1] ** 2
                self.positive += 1 if det < 0 else 2 * int(d[0, 0] + d[1, 1] > 0)
                part = a[end:, k:end] @ np.array([[d[1, 1], -d[0, 1]], [-d[0, 1], d[0, 0]]]) / det
            self.lower[end:, k:end] = part
            a[end:, end:] -= part @ a[k:end, end:]
            self.blocks.append((k, d))
            k = end

    @staticmethod
    def _pivot(a: np.ndarray, k: int) -> tuple[int, int | None]:
        if k + 1 == len(a):
            return 1, None
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax())
        most, own = column[r - k - 1], abs(a[k, k])
        if most == 0 or own >= _ALPHA * most:
            return 1, None
        row = np.abs(a[r, k:])
        row[r - k] = 0
        widest = row.max()
        if own * widest >= _ALPHA * most * most:
            return 1, None
        if abs(a[r, r]) >= _ALPHA * widest:
            return 1, r
        return 2, r

    def solve(self, b: np.ndarray, least: float) -> np.ndarray:
        """The solution for the columns of ``b``; a pivot below ``least`` counts as that, so a
        shift that is an eigenvalue yields its vector."""
        x = b[self.order].astype(np.float64)
        for k in range(len(x)):
            x[k + 1 :] -= np.outer(self.lower[k + 1 :, k], x[k])
        for k, d in self.blocks:
            if len(d) == 1:
                x[k] /= d[0, 0] if abs(d[0, 0]) > least else least
            else:
                x[k : k + 2] = np.linalg.solve(d, x[k : k + 2])
        for k in range(len(x) - 1, -1, -1):
            x[k] -= self.lower[k + 1 :, k] @ x[k + 1 :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``."""
    return Factors(matrix - shift * np.eye(len(matrix))).positive


def _isolate(matrix: np.ndarray, count: int, tol: float) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues in it), highest first, that hold the leading ``count``;
    of one eigenvalue, or narrower than ``tol``."""
    high = float((np.abs(matrix).sum(axis=1)).max()) + tol
    out, open_ = [], [(-high, high, len(matrix), 0)]
    while open_:
        low, high, above_low, above_high = open_.pop()
        held = above_low - above_high
        if held == 0 or above_high >= count:
            continue
        if held == 1 or high - low <= tol:
            out.append((low, high, held))
            continue
        middle = (low + high) / 2
        above = count_above(matrix, middle)
        open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return out


def _refine(matrix: np.ndarray, low: float, high: float, start: np.ndarray, tol: float) -> np.ndarray:
    """The unit eigenvector of the one eigenvalue between ``low`` and ``high``."""
    eye, inside_low = np.eye(len(matrix)), count_above(matrix, low)
    v, shift = start, (low + high) / 2
    best, least = v, np.inf
    while True:
        v = Factors(matrix - shift * eye).solve(v[:, None], tol)[:, 0]
        v /= np.linalg.norm(v)
        image = matrix @ v
        rho = float(v @ image)
        rest = float(np.linalg.norm(image - rho * v))
        if low <= rho <= high:
            if rest < least:
                best, least = v, rest
            elif least <= 16 * tol:
                return best
            if rest <= tol / 16 or high - low <= tol:
                return best
            if rest <= (high - low) / 4:
                shift = rho  # cubic from here
                continue
        if high - low <= tol:
            return v if not np.isfinite(least) else best
        middle = (low + high) / 2
        if count_above(matrix, middle) == inside_low:
            low = middle
        else:
            high = middle
        shift = (low + high) / 2


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues, falling, and their unit vectors as columns.

    Eigenvalues that double precision can't tell apart get some orthonormal basis. Raises
    ArithmeticError if inertia counts contradict the numbering.
    """
    n = len(matrix)
    count = min(count, n)
    scale = float(np.abs(matrix).max(initial=0))
    if count == 0 or scale == 0:
        return np.zeros(count), np.eye(n)[:, :count]
    a = matrix / scale
    tol = 8 * n * _EPS * max(1.0, float(np.linalg.norm(a)) / n**0.5)
    random = np.random.default_rng(0)
    columns: list[np.ndarray] = []

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for u in columns[::-1]:
                v = v - (u @ v) * u
        return v / np.linalg.norm(v)

    for low, high, held in _isolate(a, count, tol):
        start = random.standard_normal((n, held))
        if held == 1:
            columns.append(orthogonal(_refine(a, low, high, start[:, 0] / np.linalg.norm(start), tol)))
            continue
        block, factors = np.linalg.qr(start)[0], Factors(a - (low + high) / 2 * np.eye(n))
        for _ in range(4):
            block = np.linalg.qr(factors.solve(block, tol))[0]
        for j in range(held):
            columns.append(orthogonal(block[:, j]))
    vectors = np.stack(columns, axis=1)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    by = np.argsort(-values, kind="stable")
    values, vectors = values[by], vectors[:, by]
    for i in range(len(values)):
        lower = values[i + 1] if i + 1 < len(values) else values[i] - 32 * tol
        if values[i] - lower > 8 * tol:
            middle = (values[i] + lower) / 2 if i + 1 < len(values) else None
            if middle is not None and count_above(a, middle) != i + 1:
                raise ArithmeticError(f"eigenvalue {i + 1} is not the one of that number")
    if count_above(a, values[0] + 8 * tol) or count_above(a, values[-1] - 8 * tol) < len(values):
        raise ArithmeticError("the eigenvalues found are not the leading ones")
    return values[:count] * scale, vectors[:, :count]
