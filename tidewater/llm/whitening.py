"""Whitening of embeddings by the leading eigenvectors of their covariance.

Entries become integers, so sums and products are exact whatever the order of tasks and retries:
tasks add up their rows' integer products around the rounded mean, Spark adds the tasks' cells by
position, and the covariance is the exact fraction, rounded once. Only numbers by dimension reach
the driver, where the spectrum is sliced (``spectrum``). Rows are projected where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spectrum import leading_eigenpairs

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000  # fixed values: the integer of an entry is floor(SCALE * entry) + OFFSET
_LEAST_SHARE = 1e-12  # of the trace; an eigenvalue below is rounding, not variance
_EXACT = 1 << 52


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]  # of the integers, by dimension
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # by column
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows count (not null, all entries finite), and those rows' integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    given = np.asarray(column.is_valid())
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries are NaN
    if len(lengths) == 0 or not given.any():
        return np.zeros(len(lengths), bool), np.zeros((0, 0), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(owner, weights=~np.isfinite(entries), minlength=len(lengths)) > 0
    keep = given & ~bad
    sizes = np.unique(lengths[keep])
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes[:5].tolist()}")
    scaled = np.floor(entries[keep[owner]] * SCALE)
    if len(scaled) and np.abs(scaled).max() >= float(1 << 62):
        raise OverflowError("an entry's integer does not fit a long")
    return keep, (scaled.astype(np.int64) + OFFSET).reshape(int(keep.sum()), int(sizes[0]) if len(sizes) else 0)


def _products(y: np.ndarray) -> np.ndarray:
    """Sums over rows of the products of their entries, exact."""
    most = int(np.abs(y).max(initial=0))
    rows = max(1, _EXACT // max(1, most * most))
    if most * most > _EXACT or most * most * len(y) >= 1 << 63:
        raise OverflowError("the entries are too large for exact products")
    out = np.zeros((y.shape[1], y.shape[1]), np.int64)
    for i in range(0, len(y), rows):
        part = y[i : i + rows].astype(np.float64)
        out += (part.T @ part).astype(np.int64)
    return out


def _cells(vectors: DataFrame, cells_of, kind: str) -> dict[int, int | float]:
    """The sums, by position, of the arrays that ``cells_of`` makes of each batch's integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = integers(batch.column(0))
            if len(x):
                cells = cells_of(x)
                if total is not None and len(cells) != len(total):
                    raise ValueError("vectors of different lengths")
                if total is not None and kind == "long" and np.abs(total.astype(np.float64) + cells).max() >= 2.0**63:
                    raise OverflowError("sums over the rows do not fit a long")
                total = cells if total is None else total + cells
        if total is not None:
            arrow = pa.int64() if kind == "long" else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(arrow)), pa.array([len(total)], pa.int32())], names=["cells", "size"])

    parts = vectors.mapInArrow(run, f"cells array<{kind}>, size int").select("size", F.posexplode("cells").alias("at", "cell"))
    sums = parts.groupBy("at").agg(F.sum("cell").alias("cell"), F.min("size").alias("least"), F.max("size").alias("most")).collect()  # by dimension
    if any(r["least"] != r["most"] for r in sums):
        raise ValueError("vectors of different lengths")
    return {r["at"]: r["cell"] for r in sums}


def _vectors(rows: DataFrame, vector_col: str) -> DataFrame:
    return rows.select(F.col(vector_col).cast("array<double>").alias("v"))


def _shift(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The rounded mean, and what the sums have beside it."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(centre, np.int64), np.array([s - n * c for s, c in zip(sums, centre)], np.int64)


def fit_whitening(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The sums, eigenvalues and vectors of all rows whose vector is given and finite; None
    without such rows. Components without variance are left out, so one row, or equal rows,
    have none. Vectors of different lengths are an error, as are entries too large for exact sums."""
    vectors = _vectors(rows, vector_col)
    sums = _cells(vectors, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not sums:
        return None
    size = max(sums)
    n, total = sums[size], tuple(sums[i] for i in range(size))
    centre, rest = _shift(n, total)
    cells = _cells(vectors, lambda x: _products(x - centre).ravel(), "long")
    left = [int(r) for r in rest]
    exact = [[n * cells[i * size + j] - left[i] * left[j] for j in range(size)] for i in range(size)]  # n² times the covariance
    covariance = np.array([[v / (n * n) for v in row] for row in exact]).reshape(size, size)
    trace = sum(exact[i][i] for i in range(size)) / (n * n)
    values, found = leading_eigenpairs(covariance, components)
    kept = values > _LEAST_SHARE * trace
    return Whitening(n, total, values[kept], found[:, kept], trace)


def _project(x: np.ndarray, model: Whitening, centre: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return ((x - centre) - rest / model.n) @ model.vectors / np.sqrt(model.values)


def identity_error(rows: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity. The rows
    are centred by the mean before they are projected; what their means still have is taken off."""
    centre, rest = _shift(model.n, model.sums)
    k = len(model.values)
    if k == 0:
        return 0.0

    def cells_of(x: np.ndarray) -> np.ndarray:
        w = _project(x, model, centre, rest)
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    cells = _cells(_vectors(rows, vector_col), cells_of, "double")
    flat = np.array([cells[i] for i in range(k * k + k)])
    means = flat[k * k :] / model.n
    return float(np.abs(flat[: k * k].reshape(k, k) / model.n - np.outer(means, means) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening, vector_col: str = "embedding", result_col: str = "whitening") -> DataFrame:
    """The rows whose vector is given and finite, with a struct ``result_col``: ``deviation``, the
    sum over dimensions of (n * integer - sum)², exact, and ``whitened``, an array by component.

    Repeated rows and ids stay as they are and other columns pass unchanged, but one named
    ``result_col`` is an error.
    """
    if result_col in rows.columns:
        raise ValueError(f"the input has a column named {result_col}")
    centre, rest = _shift(model.n, model.sums)
    square = sum(int(r) ** 2 for r in rest)
    kind = pa.struct([("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])
    n = model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = integers(batch.column(batch.num_columns - 1))
            batch = batch.filter(pa.array(keep))
            if not len(x):
                continue
            y = x - centre
            widest = max(int(np.abs(y).max(initial=0)), 1)
            if len(model.sums) * widest * max(widest, int(np.abs(rest).max(initial=0))) >= 1 << 62:
                raise OverflowError("entries are too large for exact deviations")
            own, cross = (y * y).sum(axis=1).astype(object), (y @ rest).astype(object)
            deviation = pa.array((n * n * own - 2 * n * cross + square).tolist(), pa.decimal128(38, 0))
            w = _project(x, model, centre, rest)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            result = pa.StructArray.from_arrays([deviation, lists], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], result], names=[*batch.schema.names[:-1], result_col])

    given = rows.select(*[F.col(f"`{c}`") for c in rows.columns], F.col(vector_col).cast("array<double>").alias(result_col))
    out = T.StructType([*rows.schema.fields, T.StructField(result_col, T.StructType([
        T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]))])
    return given.mapInArrow(run, out)
